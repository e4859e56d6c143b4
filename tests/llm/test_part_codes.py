import hashlib
import math
import random

import numpy as np

from tests.llm.helpers import SF
from tripcast.llm import part_codes as pc
from tripcast.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, n int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """id -> (code, error, label error), and the digest of the codebooks, in plain Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    kept = [(i, v + [0] * (dim - len(v)), lab) for i, v, lab in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    p = dim // parts
    cut = lambda v, k: v[k * p:(k + 1) * p]
    books = [[cut(v, k) for _, v, _ in kept[:entries]] for k in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest(books[k], cut(v, k))[1], []).append(cut(v, k))
            for j, xs in own.items():
                books[k][j] = [sum(c) // len(xs) for c in zip(*xs)]
    out, labels = [], {}
    for i, v, lab in kept:
        best = [nearest(books[k], cut(v, k)) for k in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best), lab))
        labels[lab] = labels.get(lab, 0) + out[-1][2]
    text = ",".join(str(c) for b in books for e in b for c in e)
    return sorted(((i, code, e, labels[lab]) for i, code, e, lab in out), key=str), hashlib.sha256(text.encode()).hexdigest()


def run(spark, tmp_path, rows):
    d = str(tmp_path / f"sf{random.random()}")
    spark.createDataFrame([(i, v, lab, "x", "y", 3) for i, v, lab in rows], SCHEMA).write.parquet(f"{d}/embeddings.parquet")
    return QUERIES["op12_part_codes"](spark, d).collect()


def _same(spark, tmp_path, rows):
    got = run(spark, tmp_path, rows)
    want, digest = brute(rows)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=str) == want
    assert {r["codebooks_sha256"] for r in got} <= {digest}
    return got


def test_query_against_brute_force_on_the_small_table(spark, tmp_path):
    t = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").limit(300).collect()
    _same(spark, tmp_path, [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in t])


def test_odd_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1),
            (5, [0.5, -0.25, 0.125, 2.0], None), (6, [0.5, -0.25, 0.125, 2.0], None), (6, [0.5, -0.25, 0.125, 1.0], 2),
            (None, [0.1, 0.2, 0.3, 0.4], 2), (8, [1.0, 2.0], 2), (9, [], 3)]
    got = _same(spark, tmp_path, rows)
    assert len(got) == 6
    assert sum(r["label_error"] is None for r in got) == 0


def test_ties_copies_and_many_rows(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5, -0.5]) for _ in range(8)], i % 3) for i in range(500)]
    rows += [(1000 + i, rows[0][1], None) for i in range(300)]  # one vector makes up a third of all rows
    _same(spark, tmp_path, rows)


def test_empty_tables(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
    assert run(spark, tmp_path, [(1, None, 1)]) == []


def test_trie_shares_prefixes_and_is_exact_for_large_components():
    rng = np.random.default_rng(1)
    part = np.repeat(rng.integers(-5, 5, (300, 6)), 3, axis=0)
    part[:, 5] = rng.integers(-5, 5, 900)
    part = np.unique(part, axis=0)
    for scale in (1, 1 << 21):
        book, x = rng.integers(-5, 5, (40, 6)) * scale, part * scale
        trie = pc.Trie(book)
        code, far = trie.nearest(x)
        full = ((x[:, None].astype(object) - book[None]) ** 2).sum(axis=2)
        assert (code == full.astype(float).argmin(axis=1)).all() and (far == full.min(axis=1)).all()
        assert trie.nodes < len(x) * 3  # of 6 dimensions each, most are shared


def test_labels_are_optional(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0, -1.0, 0.25])], "vec_id long, embedding array<double>")
    coded, books = pc.compress(df, label_col=None)
    assert [tuple(r) for r in coded.collect()] == [(1, None, "00000000", 0)]
    assert pc.codebooks_text(books) == "512,1024,-1024,256"
