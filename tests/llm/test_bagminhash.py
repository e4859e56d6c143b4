import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import SF, classes, docs, shingles
from tripcast.llm import bagminhash as bm
from tripcast.llm.queries import QUERIES


def _near_copies(n, words=120, edits=4, seed=1):
    random.seed(seed)
    base = [f"w{random.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(random.randrange(edits + 1)):
            w[random.randrange(words)] = f"x{random.randrange(9999)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(spark):
    rows = [(10_000 + i, t) for i, t in enumerate(_near_copies(60) + _near_copies(40, 60, 6, 2))]
    rows += [(20_000 + i, "the same line again\n" * (30 + i)) for i in range(12)]  # weights decide
    got = {r["doc_id"]: r["class_id"] for r in bm.classes(docs(spark, [(i, t, None) for i, t in rows])).collect()}
    assert got == classes(rows)


def test_signatures_are_unbiased():
    random.seed(4)
    errors = []
    for k in range(120):
        a = " ".join(f"w{random.randrange(40)}" for _ in range(300)).split()
        b = a[:random.randrange(50, 290)]
        b = " ".join(b + [f"z{i}" for i in range(300 - len(b))])
        a = " ".join(a) + " tail of it all" * (k % 5)
        sh, doc, _, _ = bm.shingles(*bm.utf8_parts(pa.array([a, b])))
        owner, value, weight = bm.multisets(sh, doc)
        s = bm.signatures(owner, value, weight, 2)
        x, y = shingles(a), shingles(b)
        common = sum((x & y).values())
        errors.append((s[0] == s[1]).mean() - common / (sum(x.values()) + sum(y.values()) - common))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06


def test_exact_similarity():
    a, b = "a b c d e f g " * 3, "a b c d e f g " * 2 + "x"
    x, y = shingles(a), shingles(b)
    common = sum((x & y).values())
    got = bm.similarity(pa.array([a, a, None]), pa.array([b, a, a]))
    assert got.tolist() == pytest.approx([common / (sum(x.values()) + sum(y.values()) - common), 1.0, 0.0])


def test_words_of_any_script():
    texts = ["“Bonjour” : oui ! a—b", "été«x»y", "", "日本語，テキスト。a1語b", "１２ａ、x", "ที่", "—", "naïve𝔘😀𠀀𠀁z", "a", "語"]
    want = [["bonjour", "oui", "a", "b"], ["été", "x", "y"], [], [*"日本語テキスト", "a1", "語", "b"], ["１２ａ", "x"],
            [c for c in "ที่" if c.isalnum()], [], ["naïve𝔘", "𠀀", "𠀁", "z"], ["a"], ["語"]]
    h, doc = bm.words(*bm.utf8_parts(pa.array([t.lower() for t in texts])))
    for i, ws in enumerate(want):
        alone = [bm.words(*bm.utf8_parts(pa.array([w])))[0] for w in ws]
        assert h[doc == i].tolist() == [int(x) for a in alone for x in a], texts[i]
        assert all(len(a) == 1 for a in alone)


def test_copies_in_other_punctuation_and_scripts(spark):
    random.seed(9)
    plain = " ".join(f"mot{random.randrange(900)}" for _ in range(60))
    quoted = "«\u00a0" + "\u00a0".join(f"“{w}”" if k % 5 == 0 else w for k, w in enumerate(plain.split())) + "—»"
    han = "".join(chr(0x4E00 + random.randrange(4000)) for _ in range(300))
    edited = han[:100] + "好，" + han[101:200] + "。" + han[200:]
    other = "".join(chr(0x4E00 + random.randrange(4000)) for _ in range(300))
    rows = [(1, plain, None), (2, quoted, None), (3, han, None), (4, edited, None), (5, other, None), (6, "，。", None), (7, "—", None)]
    got = {r["doc_id"]: r["class_id"] for r in bm.classes(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7}


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, None), (2, "", None), (3, "...", None), (4, "Two words", None), (5, "two, WORDS!", None), (6, long, None),
            (7, long + " end", None), (8, "one repeated row of several words", None), (8, "one repeated row of several words", None),
            (None, "one repeated row of several words", None)]
    d = docs(spark, rows)
    got = {r["doc_id"]: r["class_id"] for r in bm.classes(d).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, None: None}
    kept = bm.one_per_class(d)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 6, 8]
    assert kept.filter("doc_id is null").count() == 1
    assert bm.classes(d.limit(0)).count() == 0 and bm.one_per_class(d.limit(0)).count() == 0


def test_query_covers_every_document(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = classes(rows)
    got = QUERIES["op1_bagminhash"](spark, SF).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert all(r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in got)


def test_a_large_spread_group_in_blocks(spark, monkeypatch):
    """Near copies most of which are not similar to each other, compared in
    blocks smaller than the group."""
    monkeypatch.setattr(bm, "BLOCK_ROWS", 25)
    rows = list(enumerate(_near_copies(150, 100, 9, 7)))
    want = classes(rows)
    assert 1 < len(set(want.values())) < 150
    got = {r["doc_id"]: r["class_id"] for r in bm.classes(docs(spark, [(i, t, None) for i, t in rows])).collect()}
    assert got == want
