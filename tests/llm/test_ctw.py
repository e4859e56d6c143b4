import math
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, docs
from tripcast.llm import ctw
from tripcast.llm.queries import QUERIES


def _kt(n, o):
    return math.lgamma(n - o + .5) + math.lgamma(o + .5) - math.lgamma(n + 1) - math.log(math.pi)


class Brute:
    """Context-tree weighting by recursion over all training bytes."""

    def __init__(self, texts):
        self.runs = Counter()
        for t in texts:
            z = self.marked(t)
            for j in range(ctw.DEPTH, len(z)):
                self.runs[z[j - ctw.DEPTH:j], z[j]] += 1
        self.node, self.pw = lru_cache(None)(self.node), lru_cache(None)(self.pw)

    @staticmethod
    def marked(t):
        return b"\xff" * ctw.DEPTH + (t or "").encode() + b"\xff"

    def node(self, ctx, prefix, k):
        n = o = 0
        for (c, b), v in self.runs.items():
            if c.endswith(ctx) and ((1 << k) | (b >> (8 - k))) == prefix:
                n, o = n + v, o + v * ((b >> (7 - k)) & 1)
        return n, o

    def children(self, ctx, prefix, k):
        return sum(self.pw(bytes([y]) + ctx, prefix, k) for y in {c[-len(ctx) - 1] for c, _ in self.runs if c.endswith(ctx)})

    def pw(self, ctx, prefix, k):
        n, o = self.node(ctx, prefix, k)
        if not n or len(ctx) == ctw.DEPTH:
            return _kt(n, o) if n else 0.0
        return float(np.logaddexp(_kt(n, o), self.children(ctx, prefix, k)) - math.log(2))

    def p(self, full, prefix, k, depth=0):
        ctx = full[len(full) - depth:]
        n, o = self.node(ctx, prefix, k)
        kt = (o + .5) / (n + 1)
        if not n or depth == ctw.DEPTH:
            return kt
        w = 1 / (1 + math.exp(self.children(ctx, prefix, k) - _kt(n, o)))
        return w * kt + (1 - w) * self.p(full, prefix, k, depth + 1)

    def score(self, t):
        z, out = self.marked(t), 0.0
        for j in range(ctw.DEPTH, len(z)):
            for k in range(8):
                p = self.p(z[j - ctw.DEPTH:j], (1 << k) | (z[j] >> (8 - k)), k)
                out += math.log10(p if (z[j] >> (7 - k)) & 1 else 1 - p)
        return out


ROWS = [(0, "abab", "t"), (1, "abba é", "t"), (2, "", "t"), (3, None, "t"), (4, "aab", "t"), (4, "aab", "t"), (20, "abz", "h"),
        (None, "ba", "h")]


def test_lgamma():
    x = np.concatenate([np.linspace(.5, 30, 100), [1e3, 1e7 + .5]])
    assert np.allclose(ctw.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-10)


@pytest.mark.parametrize("block_bytes", [24 << 20, 1])
def test_scores_equal_brute_force(spark, block_bytes):
    got = ctw.score(docs(spark, ROWS), F.col("lang") == "t", block_bytes=block_bytes).collect()
    model = Brute([t for _, t, s in ROWS if s == "t"])
    assert len(got) == len(ROWS)
    want = {i: (model.score(t), len((t or "").encode())) for i, t, _ in ROWS}
    for r in got:
        assert r["score"] == pytest.approx(want[r["doc_id"]][0], abs=1e-8)
        assert r["n_bytes"] == want[r["doc_id"]][1]
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / max(1, r["n_bytes"]))


@pytest.mark.parametrize("salts", [1, 5])
def test_subtrees_cut_into_groups_equal_brute_force(spark, salts):
    got = ctw.score(docs(spark, ROWS), F.col("lang") == "t", block_bytes=40, group_bytes=4, groups_per_salt=-(-20 // salts)).collect()
    model = Brute([t for _, t, s in ROWS if s == "t"])
    for r in got:
        t = next(t for i, t, _ in ROWS if i == r["doc_id"])
        assert r["score"] == pytest.approx(model.score(t), abs=1e-8)


def test_top_is_the_sum_of_its_groups():
    """The context trees of all runs, whole and cut by the third context byte."""
    texts = ["the cat sat on the mat", "the dog that sat there", "then they sat"] * 3
    runs, n = ctw._runs(pa.array(texts), np.ones(len(texts), np.int64))
    whole = ctw.Trees(runs, n)
    top = ctw.Top(*whole.top_rows())
    want = whole.log_probability(top)
    group = ctw._run_group(runs, 7, 3)
    parts = [(at, ctw.Trees(runs[at], n[at])) for _, at in ctw._by_group(group)]
    assert len(parts) > 3
    rows = [np.concatenate(x) for x in zip(*(t.top_rows() for _, t in parts))]
    ids, place = np.unique(rows[0], return_inverse=True)
    again = ctw.Top(ids, *[np.bincount(place, weights=x) for x in rows[1:]])
    for at, trees in parts:
        assert trees.log_probability(again) == pytest.approx(want[at], abs=1e-12)


TEXTS = ["", "one two  two", "x" * 5000, " ", "\n\ta b\x0bc\r\n", "é" * 700 + " ab", "word " * 900, "a", "  lead", "trail  ", "z" * 64, ""]


@pytest.mark.parametrize("piece", [16, 64, 1 << 20])
def test_pieces_of_long_texts_make_no_difference(monkeypatch, piece):
    texts = pa.array(TEXTS * 2)
    monkeypatch.setattr(ctw, "PIECE", piece)
    monkeypatch.setattr(ctw, "_PLACES", np.arange(max(piece, 16), dtype=np.uint64))
    pieces, distinct = ctw._words(texts)
    named = distinct.to_pylist()
    got = [[] for _ in texts]
    for doc, word in pieces:
        for i, w in zip(doc, word):
            got[i].append(named[w])
    assert got == [bytes(t, "utf-8").lower().split() for t in TEXTS * 2] and len(named) == len(set(named))
    code, owner = (np.concatenate(x) for x in zip(*ctw._run_pieces(texts)))
    want = []
    for i, t in enumerate(TEXTS * 2):
        z = Brute.marked(t)
        want += [(int.from_bytes(z[j - ctw.DEPTH:j + 1], "big"), i) for j in range(ctw.DEPTH, len(z))]
    assert list(zip(code.tolist(), owner.tolist())) == want
    train = np.arange(len(texts)) % 3 > 0
    runs, n = ctw._runs(texts, train.astype(np.int64))
    tally = Counter()
    for c, i in want:
        tally[c] += int(train[i])
    assert dict(zip(runs.tolist(), n.tolist())) == dict(tally) and (np.diff(runs) > 0).all()
    if piece > 256:
        order = ctw._together(code)
        assert sorted(order.tolist()) == list(range(len(code))) and (np.diff(code[order] >> 12) >= 0).all()


def test_a_text_beyond_a_block_and_a_piece(spark):
    long = "lorem ipsum dolor sit amet " * 60_000  # 1.6 MB
    rows = [(1, long, "t"), (2, "lorem ipsum", "h"), (3, long[:-1] + "!", "t"), (4, None, "t")]
    a, b = [sorted(map(tuple, ctw.score(docs(spark, rows), F.col("lang") == "t", block_bytes=n).collect())) for n in (1 << 16, 16 << 20)]
    for x, y in zip(a, b):
        assert x == pytest.approx(y, rel=1e-9)
    assert -a[0][6] / math.log10(2) < 0.02 * 8 * len(long)  # bits of a text that repeats itself


def test_probabilities_of_a_context_sum_to_one():
    model = Brute(["ab", "ab", "abc"])
    total = 0.0
    for b in range(256):
        p = 1.0
        for k in range(8):
            one = model.p(b"\xff\xffab", (1 << k) | (b >> (8 - k)), k)
            p *= one if (b >> (7 - k)) & 1 else 1 - one
        total += p
    assert total == pytest.approx(1.0)


def test_contexts_reach_six_bytes_back(spark):
    """What follows "12345" is told by the byte before it alone."""
    rows = [(i, t, "t") for i, t in enumerate(["a12345x", "b12345y"] * 20)] + [(100, "a12345x", "h"), (101, "a12345y", "h")]
    got = {r["doc_id"]: r["score"] for r in ctw.score(docs(spark, rows), F.col("lang") == "t").collect()}
    assert got[100] > got[101] + 1


def test_without_training_and_without_rows(spark):
    d = docs(spark, ROWS[:2])
    got = ctw.score(d, F.lit(False)).collect()
    assert all(r["score"] == pytest.approx(-8 * math.log10(2) * (r["n_bytes"] + 1)) and r["train_tokens"] == 0 for r in got)
    assert ctw.score(d.limit(0), F.lit(True)).count() == 0


def test_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokens = {}
    for i, t in texts.items():
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
        for c in b"\t\n\v\f\r":
            low = low.replace(bytes([c]), b" ")
        tokens[i] = [w for w in low.split(b" ") if w] + [None]
    train = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    rows = QUERIES["op4_context_tree_weighting"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        ws = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(train[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[w] + .1) / (n + .1 * (v + 1))) for w in ws))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
    held = [r for r in rows if r["held_out"]]
    assert sum(-r["score"] for r in held) / math.log10(2) / sum(r["n_bytes"] for r in held) < 3  # bits per byte
