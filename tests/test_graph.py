from collections import defaultdict

import pytest

from tests.conftest import trip
from tripcast.operators import graph as gr
from tripcast.operators.pagerank import pagerank
from tripcast.plans import catalogue as cat


def _brute_pagerank(vertices, edges, reset=0.17, tol=0.01):
    """Plain-Python reference of the tolerance-driven delta PageRank."""
    vs = sorted(set(vertices))
    mult = defaultdict(float)
    for s, d in edges:
        if s in vs and d in vs:
            mult[(s, d)] += 1.0
    outdeg = defaultdict(float)
    for (s, _), w in mult.items():
        outdeg[s] += w
    keep = 1.0 - reset
    start = keep * (reset / keep)
    rank = {v: start for v in vs}
    delta = {v: start for v in vs}
    active = set(vs)
    while True:
        msg = defaultdict(float)
        got = set()
        for (s, d), w in mult.items():
            if s in active and delta[s] > tol:
                msg[d] += delta[s] * (w / outdeg[s])
                got.add(d)
        if not got:
            break
        for v in got:
            new = rank[v] + keep * msg[v]
            delta[v] = new - rank[v]
            rank[v] = new
        active = got
    total = sum(rank.values())
    return {v: rank[v] * len(vs) / total for v in vs}


def _graph_trips(make_trips):
    pairs = [(1, 2), (1, 2), (2, 1), (2, 3), (3, 3), (3, 4), (4, 2), (5, 4), (1, 99),
             (2, 4), (2, 4), (2, 4)]
    return make_trips([trip(pu=a, do=b) for a, b in pairs])


def test_edges_vertices_triplets(make_trips, zones):
    t = _graph_trips(make_trips)
    assert cat.q17_edges(t).count() == 12
    w = {(r.src, r.dst): r.weight for r in cat.q17_edge_weights(t).collect()}
    assert w[(1, 2)] == 2 and w[(2, 4)] == 3 and w[(1, 99)] == 1
    assert cat.q17_vertices(zones).columns == ["id", "Borough", "Zone", "service_zone"]
    flat = cat.q18_triplets(t, zones)
    assert flat.count() == len(w) - 1  # the edge to 99 has no vertex
    nested = cat.q18_triplets(t, zones, flat=False).filter("edge.src = 3 and edge.dst = 3").first()
    assert nested.src.Zone == "Allerton/Pelham Gardens" and nested.edge.weight == 1
    d = gr.dangling_edge_count(gr.build_graph(zones, t)).first()
    assert (d.dangling_edges, d.dangling_trips) == (1, 1)


def test_same_attribute_pairs(make_trips, zones):
    # 2 (Queens, Boro Zone) -> 5 (Queens, Boro Zone) matches; 6 has NULL
    # service zone so 6 -> 6 never matches; self-loop 3 -> 3 matches.
    t = make_trips([trip(pu=2, do=5), trip(pu=2, do=5), trip(pu=3, do=3), trip(pu=6, do=6),
                    trip(pu=4, do=6), trip(pu=1, do=2)])
    pairs = {(r.src_id, r.dst_id): r for r in cat.q19_same_borough_service_zone_pairs(t, zones)
             .collect()}
    assert set(pairs) == {(2, 5), (3, 3)}
    assert pairs[(2, 5)].trip_count == 2 and pairs[(2, 5)].Borough == "Queens"
    s = cat.q19_pair_count(t, zones).first()
    assert (s.pair_count, s.trip_count) == (2, 3)


def test_pagerank_matches_brute_force(make_trips, zones):
    t = _graph_trips(make_trips)
    g = gr.build_graph(zones, t)
    got = {r.id: r.pagerank for r in pagerank(g.vertices, g.edges).collect()}
    ids = [r.id for r in g.vertices.collect()]
    edges = [(r.pickup_location, r.dropoff_location) for r in t.collect()]
    want = _brute_pagerank(ids, edges)
    assert set(got) == set(want)
    for v in want:
        assert got[v] == pytest.approx(want[v], rel=1e-12, abs=1e-12)
    assert sum(got.values()) == pytest.approx(len(ids))
    # an isolated vertex keeps the reset share before scaling; all isolated ones tie
    assert got[264] == pytest.approx(got[265])


def test_pagerank_other_parameters(spark):
    v = spark.createDataFrame([(i,) for i in range(6)], "id int")
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (4, 5), (5, 3), (0, 0)],
                              "src int, dst int")
    got = {r.id: r.pagerank for r in pagerank(v, e, reset=0.15, tol=0.0001).collect()}
    want = _brute_pagerank(range(6), [tuple(r) for r in e.collect()], reset=0.15, tol=0.0001)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)


def test_pagerank_top(make_trips, zones):
    t = _graph_trips(make_trips)
    top = cat.q20_pagerank_top(t, zones, k=3).collect()
    assert len(top) == 3
    assert [r.pagerank for r in top] == sorted([r.pagerank for r in top], reverse=True)


@pytest.mark.parametrize("reset,tol", [(0.0, 0.01), (1.0, 0.01), (0.17, 0.0)])
def test_pagerank_rejects_bad_parameters(spark, reset, tol):
    v = spark.createDataFrame([(1,)], "id int")
    e = spark.createDataFrame([(1, 1)], "src int, dst int")
    with pytest.raises(ValueError):
        pagerank(v, e, reset=reset, tol=tol)


def test_pagerank_of_a_star_with_salted_hub(spark, monkeypatch):
    from tripcast.operators import pagerank as pr
    monkeypatch.setattr(pr, "LINKS_PER_SALT", 7)
    edges = [(0, i) for i in range(1, 41)] + [(i, 0) for i in range(1, 41)] + [(1, 2)]
    v = spark.range(41).selectExpr("id")
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.pagerank for r in pr.pagerank(v, e).collect()}
    want = _brute_pagerank(range(41), edges)
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_pagerank_round_bound_follows_its_parameters(spark):
    from tripcast.operators.pagerank import pagerank, round_bound
    assert round_bound(0.001, 1e-9, 3) > 13_000 and round_bound(0.17, 0.01, 25) < 60
    v = spark.range(3).selectExpr("id")
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "src long, dst long")
    got = pagerank(v, e, reset=0.001, tol=9.6e-4).collect()   # about 40 rounds
    assert all(abs(r.pagerank - 1.0) < 1e-9 for r in got)


def test_pagerank_leaves_only_its_last_state(spark):
    import os

    from tripcast.operators.pagerank import pagerank
    from tripcast.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    e = spark.createDataFrame([(0, 1), (1, 0)], "src long, dst long")
    assert pagerank(spark.range(2).selectExpr("id"), e).count() == 2
    (new,) = [x for x in set(os.listdir(root)) - before if x.startswith("pagerank-")]
    assert len(os.listdir(os.path.join(root, new))) == 1


def test_pagerank_top_orders_before_it_rounds(spark, monkeypatch):
    ranks = spark.createDataFrame([(1, 1.10835504), (2, 1.10835515), (3, 0.5)], "id int, pagerank double")
    monkeypatch.setattr(cat, "pagerank", lambda *a, **k: ranks)
    monkeypatch.setattr(cat.gr, "build_graph", lambda z, t: type("G", (), {"vertices": None, "edges": None}))
    assert [(r.id, r.pagerank) for r in cat.q20_pagerank_top(None, None, k=2).collect()] == [(2, 1.108355), (1, 1.108355)]
