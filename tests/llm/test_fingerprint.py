import hashlib

import numpy as np

from tests.llm.helpers import SF, docs
from tripcast.llm import fingerprint as fp
from tripcast.llm.queries import QUERIES


def _sets(t):
    b = t.encode()
    return {b[i:i + fp.SHINGLE] for i in range(len(b) - fp.SHINGLE + 1)} or ({b} if b else set())


def _jaccard(a, b):
    a, b = _sets(a), _sets(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def _expected(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        nxt, n = rows[(k + 1) % len(rows)][1], len(t) // 4
        changed = t[:len(t) - n] + nxt[:n]
        out[i] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), changed, nxt)
    return out


def test_query_against_exact_similarity(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, texts = _expected(rows), dict(rows)
    got = QUERIES["op5_fingerprints"](spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    errors = []
    by_text = {}
    for r in got:
        n, sha, changed, nxt = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        t = texts[r["doc_id"]]
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        errors += [r["near_edited"] - _jaccard(t, changed), r["near_next"] - _jaccard(t, nxt)]
        assert len(r["fingerprint"]) == fp.BINS * fp.BITS // 4
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_next_document_over_many_ranges(spark):
    for n in (0, 1, 2, 9, 40):
        rows = [(i * i, f"text number {i} " * (i % 4)) for i in range(n)]
        d = docs(spark, [(i, t, None) for i, t in rows])
        want = _expected(rows) if n else {}
        for ranges in (1, 5, 64):
            got = {r["doc_id"]: r for r in fp.compare_with_next(d, ranges=ranges).collect()}
            assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in got.items()} == {i: w[:2] for i, w in want.items()}


def test_edge_cases(spark):
    long = "many words in a long text " * 40_000
    d = docs(spark, [(None, None, None), (1, "", None), (2, "abc", None), (2, "abc", None), (3, long, None), (4, "ab😀", None)])
    got = {}
    for r in fp.compare_with_next(d, ranges=3).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[2]) == 2 and got[2][0]["fingerprint"] == got[2][1]["fingerprint"]
    assert got[1][0]["fingerprint"] == "" and got[1][0]["near_edited"] == 1.0 and got[1][0]["near_next"] == 0.0
    assert got[None][0]["n_chars"] == 0 and got[3][0]["n_chars"] == len(long) and got[4][0]["n_chars"] == 3


def test_ranges_split_an_id_that_fills_several(spark):
    rows = [(None, f"text {i} of no id") for i in range(300)] + [(i, f"text {i}") for i in range(100)]
    d = docs(spark, [(i, t, None) for i, t in rows])
    own = fp.with_next(d, "text", "doc_id", 40).filter("not successor")
    sizes = {r["r"]: r["count"] for r in own.groupBy("r").count().collect()}
    assert len(sizes) >= 30 and max(sizes.values()) <= 30 and sum(sizes.values()) == 400
    order = [r["text"] for r in own.orderBy("o", "t").collect()]
    want = [hashlib.sha256(fp.edited(a, b).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1])]
    got = fp.compare_with_next(d, ranges=40).collect()
    assert sorted(r["edited_sha256"] for r in got) == sorted(want)


def test_limits_by_binary_search(spark):
    quantiles = [3, 3, 3, 7, 9, 9, 20]
    limits = fp._limits(quantiles)
    assert len(limits) == 7 and limits == sorted(limits)
    rows = [(o, t) for o in range(22) for t in (-(1 << 63), -(1 << 61), 0, 1 << 62, (1 << 63) - 1)]
    d = spark.createDataFrame(rows, "o long, t long")
    for n in range(8):
        got = d.select("o", "t", fp._limits_at_or_below(limits[:n], d["o"], d["t"]).alias("r")).collect()
        assert all(r["r"] == sum(x <= (r["o"], r["t"]) for x in limits[:n]) for r in got)


def test_densification_fills_every_bin():
    empty = np.iinfo(np.uint64).max
    least = np.full((3, fp.BINS), empty, np.uint64)
    least[0, 7] = 42
    least[1, [3, 200]] = [5, 6]
    full = fp._densified(least)
    assert (full[0] == 42).all() and set(full[1].tolist()) == {5, 6} and (full[2] == empty).all()
