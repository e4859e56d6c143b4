import math
import random
import re
from collections import Counter

import numpy as np

from tests.llm.helpers import SF
from tripcast.llm import lexical as lx
from tripcast.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=20):
    split = lambda t: TERM.findall((t or "").translate(LOWER))
    tf = [(i, Counter(split(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in tf:
            if c:
                m = 75 + (25 * sum(c.values()) * n_docs) // total
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                            * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
                if score > 0:
                    found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in docs], "doc_id long, text string, source string, rank int, score long")
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id long")
    return sorted((tuple(r) for r in lx.search(d, q, **more).collect()), key=str)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op13_fp_tree_search"](spark, SF).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_random_texts_blocks_and_small_trees(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["É", "ß", "中文"]
    text = lambda n: " ".join(rng.choice(words[:max(3, rng.randrange(len(words)))]) for _ in range(n))
    docs = [(i, text(rng.randrange(40))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(150)]  # one text makes up a third of all rows
    items = [(i, text(12)) for i in range(9)]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_bytes=64) == want  # several blocks of items
    assert [r for r in run(spark, docs, items, k=3)] == brute(docs, items, 3)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "... --"), (4, "Alpha beta ALPHA"), (4, "alpha"), (None, "alpha"), (6, "alpha"),
            (7, "é" * 5 + " beta"), (8, "beta " * 100_000)]
    items = [(1, "alpha alpha beta"), (1, "alpha"), (2, None), (3, ""), (4, "unknown"), (None, "beta")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []


def _tree(vectors, k=20):
    first = np.cumsum([0, *map(len, vectors)])
    rank = np.array([r for v in vectors for r, _ in v], np.int64)
    tf = np.array([t for v in vectors for _, t in v], np.int64)
    return lx.Tree(list(range(len(vectors))), np.full(len(vectors), 100), first, rank, tf, 40, k)


def test_tree_leaves_out_subtrees_and_stays_exact():
    rng = random.Random(2)
    vectors = [[(r, rng.randrange(1, 4)) for r in sorted(rng.sample(range(40), rng.randrange(1, 12)))] for _ in range(3000)]
    vectors[1234] = [(0, 9), (1, 9), (2, 9)]
    items = lx.indexed([0], ["w0 w1 w2"])
    df = np.array([sum(r == i for v in vectors for r, _ in v) for i in range(40)])
    order = np.lexsort((np.arange(40), -df))
    where = np.empty(40, int)
    where[order] = np.arange(40)
    vectors = [sorted((int(where[r]), t) for r, t in v) for v in vectors]
    scorer = lx.Scorer(items, df[:3], 3000)
    scorer.rank, scorer.first = where, np.searchsorted(np.sort(where[:3]), np.arange(41))  # items hold three of the forty terms
    scorer.gain = scorer.gain[np.argsort(where[:3][np.argsort(np.argsort(-df[:3], kind="stable"))], kind="stable")]
    tree, best = _tree(vectors), lx.Best(1, 2)
    tree.search(scorer, best)
    every = [(int(scorer(np.zeros(len(v), np.int64), *np.array(v, np.int64).T, np.array([100]), 1)[0, 0]), -i) for i, v in enumerate(vectors)]
    assert sorted((s, d) for s, _, d in best.heaps[0]) == sorted(every)[-2:]
    assert tree.scored < 2000 and len(tree.nodes) > 10


def test_scores_beyond_doubles_add_up(spark):
    items = lx.indexed([0], ["a"])
    scorer = lx.Scorer(items, np.array([1]), 10)
    scorer.gain = scorer.gain * (1 << 28)
    exact = lx.Scorer(items, np.array([1]), 10)
    exact.gain, exact.exact = scorer.gain, False
    args = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([3]), np.array([90]), 1)
    assert int(exact(*args)[0, 0]) == int(scorer.gain[0]) * (3_000_000_000 // (3000 + 1080))
