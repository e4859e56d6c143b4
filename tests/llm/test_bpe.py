import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import SF, docs
from tripcast.llm import bpe, chunk_reuse, token_counts
from tripcast.llm.queries import QUERIES

TEXTS = ["", " ", "x" * 40_000, "日本語テキスト" * 4000, "a <|endoftext|> b" * 2500, " " * 20_000 + "x", "ab  c\r\n\t" * 4000,
         "I'm you'll 's'sa" * 3000, "é  　x \x1c y" * 2000, "<|endoftext|", "0123 " * 9000]


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(bpe.default_path())


@pytest.fixture(scope="module")
def lib():
    return bpe.library(bpe.default_path())


def _whole(lib, text):
    return lib.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(enc, lib):
    random.seed(5)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'", "'s", "é", "日", " ", " ", "\x85", "1", "²", "😀", "<|", "<|endoftext|>", "."]
    texts = TEXTS + ["".join(random.choices(alphabet, k=60)) for _ in range(800)]
    texts += ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}x" for c in range(s, min(s + 512, 0xD800), 7))
              for s in range(0, 0xD800, 512)]
    for t in texts:
        ids = _whole(lib, t)
        assert enc.encode(t) == ids, t[:60]
        assert enc.decode(ids) == lib.decode(ids, skip_special_tokens=False) == t


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "ab " + "\n" * 1_200_000 + "c d <|endoftext|> e"])
def test_white_space_beyond_the_fast_matcher(enc, lib, text):
    ids = _whole(lib, text)
    assert enc.encode(text) == ids and enc.decode(ids) == text
    raw = text.encode()
    assert token_counts.count_tokens(enc, raw)[0] == len(ids)
    store = chunk_reuse.Store(enc)
    assert chunk_reuse.encode(store, raw, chunk_reuse._bounds(raw, chunk_reuse._cut_points(np.frombuffer(raw, np.uint8)))).tolist() == ids


@pytest.mark.parametrize("chunk,overlap", [(40, 4), (300, 16), (4096, 32)])
def test_spliced_counts_equal_the_whole(enc, chunk, overlap):
    for t in [x[:6000] for x in TEXTS] + TEXTS[3:5]:
        if len(t) > 6000 and chunk < 300:
            continue
        n, made = token_counts.count_tokens(enc, t.encode(), chunk, overlap)
        assert n == len(enc.encode(t)), (t[:40], chunk)
        assert (made == 1) == (len(t.encode()) <= chunk)


@pytest.mark.parametrize("small", [False, True])
def test_chunked_ids_equal_the_whole(enc, monkeypatch, small):
    if small:
        for k, v in (("MIN_CHUNK", 4), ("MAX_CHUNK", 40), ("CUT_BITS", 4)):
            monkeypatch.setattr(chunk_reuse, k, v)
    store = chunk_reuse.Store(enc, most=20_000)  # evicts all the time
    for t in [x[:5000] for x in TEXTS] * 2 + TEXTS:
        parts = chunk_reuse.chunks(t)
        assert b"".join(parts) == t.encode()
        bounds = [0, *np.cumsum([len(p) for p in parts]).tolist()]
        assert chunk_reuse.encode(store, t.encode(), bounds).tolist() == enc.encode(t), t[:40]


def _unspaced(n, seed=3):
    rng = random.Random(seed)
    pools = ["".join(map(chr, range(0x4E00, 0x9FF0, 7))), "".join(map(chr, range(0x3041, 0x30FF))), "".join(map(chr, range(0x0E01, 0x0E4F)))]
    marks = "。、，！？：；「」（）《》　 \n\u00a0\u2003…—・"
    return "".join(rng.choice(marks) if rng.random() < 0.08 else rng.choice(pools[min(i // 4000 % 4, 2)]) for i in range(n))


def test_cuts_are_stable_in_any_surroundings(enc):
    """The tokens of both sides of a cut are those of the whole."""
    rng = random.Random(8)
    alphabet = ["a", "é", " ", "  ", "\n", "'", "'s", "漢", "字", "か", "ナ", "ー", "。", "，", "（", "）", "「", "\u3000", "\u00a0", "\u2003", "\x85",
                "\u2028", "\u202f", "\u205f", "\u1680", "ไ", "1", "．", "ｦ", "々", "〇", "䷀", "😀", "<|endoftext|>", "!"]
    seen = 0
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=14))
        raw = text.encode()
        whole = enc.encode(text)
        for m in bpe.STABLE.finditer(raw):
            if 0 < m.start() < len(raw):
                left, right = raw[:m.start()].decode(), raw[m.start():].decode()
                assert enc.encode(left) + enc.encode(right) == whole, (text, m.start())
                seen += 1
    assert seen > 2000


class Counting:
    """An encoder that counts the bytes it is given."""

    def __init__(self, enc):
        self.enc, self.bytes = enc, 0

    def __getattr__(self, name):
        return getattr(self.enc, name)

    def encode(self, text):
        self.bytes += len(text.encode())
        return self.enc.encode(text)


def test_unspaced_scripts_are_encoded_hardly_more_than_once(enc):
    text = _unspaced(60_000)
    raw, whole = text.encode(), enc.encode(text)
    counting = Counting(enc)
    assert token_counts.count_tokens(counting, raw)[0] == len(whole)
    assert counting.bytes < 1.3 * len(raw)
    store = chunk_reuse.Store(counting)
    counting.bytes = 0
    for t in (text, "前置き。" + text, text + "後書き"):
        b = chunk_reuse.chunks(t)
        assert chunk_reuse.encode(store, t.encode(), [0, *np.cumsum([len(p) for p in b]).tolist()]).tolist() == enc.encode(t)
    assert store.reused > 1.5 * store.encoded
    assert counting.bytes < 2 * len(raw)  # for three texts


def test_texts_of_one_key_are_dealt_over_their_ranges():
    limits = np.array([-5, 3, 3, 3, 9])
    place = chunk_reuse._range_of(limits).func
    texts = ["same text"] * 1000
    key = chunk_reuse._routing_keys(chunk_reuse.pa.array(texts))[0]
    spread = chunk_reuse._range_of(np.array([key - 1, key, key, key, key + 1])).func(
        chunk_reuse.pd.Series(texts), chunk_reuse.pd.Series(np.arange(-500, 500)))
    assert set(spread) == {1, 2, 3, 4} and min(np.bincount(spread)[1:]) > 200
    assert len(place(chunk_reuse.pd.Series([], dtype=str), chunk_reuse.pd.Series([], dtype="int64"))) == 0


def test_shared_passages_are_encoded_once(enc):
    random.seed(2)
    passage = " ".join("".join(random.choices("abcdefgh", k=5)) for _ in range(9000))
    store = chunk_reuse.Store(enc)
    for head in ("one head", "another, longer head"):
        t = head + passage
        b = chunk_reuse.chunks(t)
        chunk_reuse.encode(store, t.encode(), [0, *np.cumsum([len(p) for p in b]).tolist()])
    assert store.reused >= 0.8 * store.encoded


def _rows(enc, texts):
    return {i: (len((t or "").encode()), enc.encode(t or "")) for i, t in enumerate(texts)}


def test_operators_edge_cases(spark, enc):
    texts = [None, *TEXTS[:5]]
    d = docs(spark, [(i, t, None) for i, t in enumerate(texts)] + [(1, "", None), (None, "no id", None)])
    want = _rows(enc, texts)
    got = token_counts.count(d.withColumnRenamed("score", "n_tokens")).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_bytes"], r["n_tokens"]) == (want[r["doc_id"]][0], len(want[r["doc_id"]][1]))
    got = chunk_reuse.coded(d).collect()
    assert len(got) == len(texts) + 2 and "matches" in got[0].asDict()
    for r in got:
        if r["doc_id"] is not None:
            assert r["ids"] == want[r["doc_id"]][1] and r["decoded"] == (texts[r["doc_id"]] or "")
    assert token_counts.count(d.limit(0)).count() == 0 and chunk_reuse.coded(d.limit(0)).count() == 0


def test_queries_equal_the_library(spark, lib):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts = {r["doc_id"]: r for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    codes = {r["doc_id"]: r for r in QUERIES["op8_bpe_chunk_reuse"](spark, SF).collect()}
    assert set(counts) == set(codes) == set(texts)
    for i, t in texts.items():
        ids = _whole(lib, t)
        assert (counts[i]["n_bytes"], counts[i]["n_tokens"], counts[i]["over_limit"]) == (len(t.encode()), len(ids), len(ids) > 512)
        assert codes[i]["n_tokens"] == len(ids)
        assert codes[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert codes[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
