import random
import time
import tracemalloc

import pyarrow as pa
import pytest

from tests.llm.helpers import SF, docs
from tripcast.llm import decontaminate as dc
from tripcast.llm.queries import QUERIES


def _distance(item, text):
    """Least edit distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        nxt = [i + 1]
        for j, y in enumerate(text):
            nxt.append(min(row[j] + (x != y), row[j + 1] + 1, nxt[-1] + 1))
        row = nxt
    return min(row)


def test_edited_passages_equal_brute_force(spark):
    random.seed(3)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:12]
    texts = []
    for k, (_, t) in enumerate(items * 2):
        s = list(t)
        for _ in range(int(len(s) * (0.02, 0.06, 0.09, 0.13)[k % 4])):
            p, how = random.randrange(len(s)), random.randrange(3)
            s[p:p + 1] = {0: [random.choice("abcde")], 1: [], 2: [s[p], random.choice("abcde")]}[how]
        texts.append("before it, some words. " + "".join(s) + " and behind it others")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: {m["item_id"]: m for m in r["matches"]}
           for r in dc.scan(docs(spark, [(i, t, None) for i, t in enumerate(texts)]), bench).collect()}
    index = dc.Index(dc.Items(tuple(i for i, _ in items), tuple(t for _, t in items)))
    hits = 0
    for k, t in enumerate(texts):
        for n, (i, item) in enumerate(items):
            if n != k % len(items):
                continue
            want = _distance(dc.normalised(item).tolist(), dc.normalised(t).tolist())
            assert (i in got[k]) == (want <= index.budget[n]), (k, want)
            if i in got[k]:
                m, hits = got[k][i], hits + 1
                assert m["distance"] == want
                assert _distance(dc.normalised(item).tolist(), dc.normalised(t[m["start"]:m["end"]]).tolist()) == want
    assert 8 <= hits < len(texts)


def test_edge_cases(spark):
    passage = "A passage of the benchmark that is long enough to be split into many q-grams, with commas; and more."
    rows = [(1, None, None), (2, "", None), (3, "clean text without anything", None), (4, "x " + passage.upper().replace(" ", "\n  "), None),
            (4, "x " + passage.upper().replace(" ", "\n  "), None), (5, "well yes no", None), (6, "yesterday", None),
            (7, "word " * 60_000 + passage, None), (None, passage, None)]
    bench = spark.createDataFrame([(1, passage), (2, None), (3, "?!"), (None, passage), (4, "Yes"), (5, passage)], "item_id long, text string")
    d = docs(spark, rows)
    for chars in (4_000_000, 60):  # one block of items, several
        out = dc.scan(d, bench, block_chars=chars)
        assert out.columns.count("matches") == 1 and len(out.columns) == len(d.columns)
        got = sorted(((r["doc_id"] or 0, sorted((m["item_id"], m["distance"]) for m in r["matches"])) for r in out.collect()))
        both = [(1, 0), (5, 0)]
        assert got == [(0, both), (1, []), (2, []), (3, []), (4, both), (4, both), (5, [(4, 0)]), (6, []), (7, both)]
    assert dc.scan(d.limit(0), bench).count() == 0
    assert {len(r["matches"]) for r in dc.scan(d, bench.limit(0)).collect()} == {0}


def test_query_finds_every_verbatim_item(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(r["doc_id"], i) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for i, t in items if t in r["text"]}
    got = QUERIES["op3_benchmark_decontamination"](spark, SF).collect()
    assert want and want <= {(r["doc_id"], r["item_id"]) for r in got}
    assert {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0} == want


OPENING = "the question below has one right answer, choose it and say why: "


def _templated(n, seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    return [(i, OPENING + " ".join(word() for _ in range(8))) for i in range(n)], word


@pytest.mark.parametrize("portion", [1 << 20, 50])
def test_items_with_one_opening_equal_brute_force(monkeypatch, portion):
    monkeypatch.setattr(dc, "PORTION", portion)
    items, word = _templated(25)
    rng = random.Random(6)
    texts = [OPENING, OPENING * 3, "x " + OPENING + "something else altogether, of many words that no item has", ""]
    for i in (3, 9, 17):
        s = list(items[i][1])
        for _ in range(i // 2):
            s[rng.randrange(len(s))] = rng.choice("abc")
        texts.append(" ".join(word() for _ in range(rng.randrange(60))) + " " + "".join(s) + " " + OPENING)
    index = dc.Index(dc.Items(tuple(i for i, _ in items), tuple(t for _, t in items)))
    raw, off = dc.utf8_parts(dc.pa.array(texts))
    got = [{m[0]: m[1] for m in found} for found in index.matches(raw, off)]
    hits = 0
    for text, found in zip(texts, got):
        for n, (i, item) in enumerate(items):
            want = _distance(dc.normalised(item).tolist(), dc.normalised(text).tolist())
            assert (i in found) == (want <= index.budget[n])
            hits += i in found and found[i] == want
    assert hits >= 3


def test_a_shared_opening_costs_no_alignment():
    """Documents that quote an opening of 5,000 items: every item is met, hardly one is aligned."""
    items, _ = _templated(5000)
    index = dc.Index(dc.Items(tuple(i for i, _ in items), tuple(t for _, t in items)))
    texts = [f"document {k}, where someone writes. {OPENING}and then goes on about other things at some length" for k in range(40)]
    raw, off = dc.utf8_parts(dc.pa.array(texts))
    began = time.perf_counter()
    assert index.matches(raw, off) == [[]] * 40
    codes, noff, _ = dc._normalised(*dc._code_points(raw, off))
    assert len(index.candidates(codes, noff)) < 4000  # of 200,000 pairs
    assert time.perf_counter() - began < 12


def test_blocks_of_items_give_the_same(spark):
    items, _ = _templated(40)
    rows = [(i, f"before {items[i % 40][1]} behind", None) for i in range(60)] + [(100, items[3][1], None), (101, items[3][1], None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want, got = [sorted(map(str, dc.scan(docs(spark, rows), bench, block_chars=n).collect())) for n in (4_000_000, 250)]  # 1 and 20 blocks
    assert got == want


def test_a_batch_of_texts_is_matched_in_little_memory():
    random.seed(5)
    words = ["".join(random.choices("abcdefghijklmnop", k=random.randrange(2, 9))) for _ in range(4000)]
    passage = " ".join(random.choices(words, k=40))
    texts = [" ".join(random.choices(words, k=500)) for _ in range(1600)]  # some 5 MB
    for i in (0, 777, 1599):
        texts[i] += " " + passage
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    assert batch.nbytes > 4 << 20
    index = dc.Index(dc.Items((9,), (passage,)))
    tracemalloc.start()
    try:
        got = [r for part in dc._matched(batch, index, ["doc_id", "text"], "text") for r in part.select(["doc_id", "matches"]).to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    assert {r["doc_id"]: [(m["item_id"], m["distance"]) for m in r["matches"]] for r in got if r["matches"]} == {
        i: [(9, 0)] for i in (0, 777, 1599)}
    assert peak < 64 << 20, peak
