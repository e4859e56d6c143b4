"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared as lower-case letters and digits with every run of other
characters as one space.  A benchmark item of m characters occurs in a document
when some stretch of the document is within k edits of it, k = ``rate`` * m (at
most m // q - 1, so that the filter below stays lossless).  By the q-gram lemma
such a stretch shares at least m + 1 - q * (k + 1) of the item's q-grams, on
diagonals (document position minus item position) at most k apart.  Shared
q-grams are counted in overlapping bands of 2 * (k + 1) diagonals; bands that
reach the bound are verified by an alignment restricted to the band.  Items
shorter than q are searched for as they stand, between word edges.

q-grams that stand in the same items at the same distances (those of an opening
that many items share, or all of one item) are one posting list, counted once per
diagonal and only then counted for its items.  A band that reaches the bound is first held
against the lemma for the item's 3-grams: a stretch within k edits has all but 3k of them,
so an item that shares no more than the opening is set aside without alignment.

The benchmark is shipped to the tasks in blocks of at most ``block_chars``
characters, each block one pass over the documents without a shuffle, so what is
broadcast is bounded.  With several blocks each pass stores its few
matches by a hash of the text, and they are joined back at the end, so a task holds one block.
Hits are expanded in portions of PORTION, long texts in windows that overlap by
the longest stretch an item can match.

Edge cases: null or empty documents have no match, null or empty items (no
letter or digit) match nothing; equal items and repeated documents each give
their own rows.  Other columns are carried along, and a column named like an
output is replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.common import give_back, held, slices, stored, table, utf8_parts
from tripcast.operators.broadcast import checked_broadcast

Q = 8  # a q-gram is one 64-bit word
RATE = 0.1
HASH_BITS = 20
THIRDS = 256  # kinds of 3-grams told apart
PORTION = 1 << 18  # hits expanded at once
TEXT_BYTES = 1 << 19  # text matched by one call: its arrays take some fifty times that
MATCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
                      T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()),
                                  ("end", pa.int32())]))


@functools.lru_cache(maxsize=1)
def _plain() -> np.ndarray:
    """Lower-case form of each 16-bit code point, a space where it is neither
    letter nor digit.  Higher code points count as letters."""
    out = np.full(65536, 32, np.uint32)
    for c in range(65536):
        ch = chr(c)
        if ch.isalnum():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _normalised(codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised code points of the texts, their offsets, and the position in
    ``codes`` of each."""
    out = _plain()[np.minimum(codes, 65535)]
    out = np.where(codes > 65535, codes, out)
    space = out == 32
    drop = np.zeros(len(out), bool)
    if len(out):
        drop[1:] = space[1:] & space[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        drop[heads] = space[heads]
    kept = np.concatenate([[0], np.cumsum(~drop)])
    return out[~drop], kept[off], np.flatnonzero(~drop)


def _code_points(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-32 of UTF-8 texts and the offsets in code points."""
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return codes, heads[off]


def normalised(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = _normalised(codes, np.array([0, len(codes)]))[0]
    return out[:-1] if len(out) and out[-1] == 32 else out


def _words(codes: np.ndarray) -> np.ndarray:
    """The Q characters from each position as one 64-bit word; characters fold
    to a byte each, which can only add q-grams in common, never lose one."""
    folded = np.where(codes < 128, codes, 128 | ((codes * np.uint32(2654435761)) >> np.uint32(25))).astype(np.uint8)
    if len(folded) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(folded) - Q + 1,), "<u8", folded.tobytes(), strides=(1,)).copy()


def _thirds(codes: np.ndarray) -> np.ndarray:
    """Kind of the three characters from each position."""
    c = codes.astype(np.uint32)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    return ((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(24)).astype(np.int64)


def _slot(words: np.ndarray) -> np.ndarray:
    return ((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Items:
    """A block of benchmark items: ids and texts."""
    ids: tuple[int, ...]
    texts: tuple[str, ...]
    rate: float = RATE


class Index:
    """q-grams of a block of items."""

    def __init__(self, items: Items):
        norm = [normalised(t) for t in items.texts]
        chosen = [i for i, n in enumerate(norm) if len(n)]
        self.ids = [items.ids[i] for i in chosen]
        self.codes = [norm[i] for i in chosen]
        self.size = np.array([len(c) for c in self.codes], np.int64)
        self.budget = np.maximum(np.minimum((self.size * items.rate).astype(np.int64), self.size // Q - 1), 0)
        self.bound = self.size + 1 - Q * (self.budget + 1)
        self.short = [i for i, m in enumerate(self.size) if m < Q]
        self.longest = int(self.size.max(initial=0))
        grams = [_words(c) for c in self.codes]
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        words = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.lexsort((place, item, words))
        item, place = item[order], place[order]
        self.word, first, times = np.unique(words[order], return_index=True, return_counts=True)
        # Posting lists: the items of a q-gram and their places from its first one on.
        shift = place - np.repeat(place[first], times) if len(first) else place
        lists: dict[bytes, int] = {}
        self.list, self.base = np.zeros(len(self.word), np.int64), place[first] if len(first) else place
        chosen = []
        both = np.stack([item, shift], axis=1) if len(item) else np.zeros((0, 2), np.int64)
        for w, (a, n) in enumerate(zip(first, times)):
            number = lists.setdefault(both[a:a + n].tobytes(), len(lists))
            if number == len(chosen):
                chosen.append((a, n))
            self.list[w] = number
        self.times = np.array([n for _, n in chosen], np.int64)
        self.first = np.cumsum(self.times) - self.times
        entry = np.concatenate([np.arange(a, a + n) for a, n in chosen]) if chosen else np.zeros(0, np.int64)
        self.item, self.shift = item[entry], shift[entry]
        self.maybe = np.zeros(1 << HASH_BITS, bool)
        self.maybe[_slot(self.word)] = True
        self.thirds = np.zeros((len(self.codes), THIRDS), np.uint8)  # how often an item has 3-grams of each kind
        for i, c in enumerate(self.codes):
            self.thirds[i] = np.minimum(np.bincount(_thirds(c), minlength=THIRDS), 255)

    def candidates(self, codes: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, first and last diagonal relative to the text) of bands
        whose shared q-grams reach the bound."""
        words = _words(codes)
        if not len(words) or not len(self.word):
            return []
        at = np.flatnonzero(self.maybe[_slot(words)])
        k = np.searchsorted(self.word, words[at])
        k[k == len(self.word)] = 0
        same = self.word[k] == words[at]
        at, k = at[same], k[same]
        doc = np.searchsorted(off, at, side="right") - 1
        inside = at + Q <= off[doc + 1]
        at, k, doc = at[inside], k[inside], doc[inside]
        reach = self.longest + 2 * int(self.budget.max(initial=0)) + Q
        found: set[tuple[int, int, int, int]] = set()
        begin, weight = 0, np.concatenate([[0], np.cumsum(self.times[self.list[k]])])
        while begin < len(at):
            # A window of PORTION hits, or longer than it overlaps with the next one.
            end = min(max(int(np.searchsorted(weight, weight[begin] + PORTION)), int(np.searchsorted(at, at[begin] + 2 * reach))), len(at))
            found.update(self._bands(at[begin:end], k[begin:end], doc[begin:end], off))
            if end == len(at):
                break
            begin = max(int(np.searchsorted(doc, doc[end])), int(np.searchsorted(at, at[end] - reach)))
        return self._shared_enough(sorted(found), codes, off)

    def _bands(self, at: np.ndarray, k: np.ndarray, doc: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Bands that reach the bound by these hits."""
        size = int((np.diff(off)[doc].max(initial=0) + 2 * self.longest) + 2)
        diagonal = at - off[doc] - self.base[k] + self.longest  # of the list's first item
        texts, text = np.unique(doc, return_inverse=True)
        met, n = np.unique((text * len(self.times) + self.list[k]) * size + diagonal, return_counts=True)
        diagonal, pair = met % size, met // size
        own, text = pair % len(self.times), pair // len(self.times)
        times = self.times[own]
        entry = np.repeat(self.first[own], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, text, n = self.item[entry], np.repeat(text, times), np.repeat(n, times)
        diagonal = np.repeat(diagonal, times) - self.shift[entry] + self.longest  # not negative
        size += self.longest
        key = (text * len(self.ids) + item) * size + diagonal // (self.budget[item] + 1)
        order = key.argsort()
        key, n = key[order], n[order]
        first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
        if not len(first):
            return []
        key, n = key[first], np.add.reduceat(n, first)
        both = n.copy()  # a band and the next one
        follows = np.flatnonzero(key[1:] == key[:-1] + 1)
        both[follows] += n[follows + 1]
        band, pair = key % size, key // size
        item = pair % len(self.ids)
        good = np.flatnonzero(both >= self.bound[item])
        width = self.budget[item[good]] + 1
        low = band[good] * width - 2 * self.longest
        return list(zip(texts[pair[good] // len(self.ids)].tolist(), item[good].tolist(), low.tolist(), (low + 2 * width - 1).tolist()))

    def _shared_enough(self, bands: list[tuple[int, int, int, int]], codes: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The bands whose stretch of text has all but 3k of the item's 3-grams."""
        out = []
        for i in range(0, len(bands), 1024):
            doc, item, low, high = (np.array(x) for x in zip(*bands[i:i + 1024]))
            a = np.maximum(off[doc], off[doc] + low - self.budget[item])
            b = np.minimum(off[doc + 1], off[doc] + high + self.budget[item] + self.size[item])
            n = np.maximum(b - a, 0)
            row = np.repeat(np.arange(len(doc)), n)
            text = codes[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
            kind = _thirds(text)
            row, whole = row[:max(len(text) - 2, 0)], row[:max(len(text) - 2, 0)] == row[2:]
            seen = np.bincount(row[whole] * THIRDS + kind[whole], minlength=len(doc) * THIRDS).reshape(-1, THIRDS)
            mine = self.thirds[item]
            shared = np.minimum(mine, seen).sum(axis=1)
            need = mine.sum(axis=1, dtype=np.int64) - 3 * self.budget[item]
            out += [bands[i + j] for j in np.flatnonzero(shared >= need)]
        return out

    def matches(self, raw: np.ndarray, off: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """Per text: (item id, distance, start, end) of every item found, at its
        best place, in code points of the text."""
        points, poff = _code_points(raw, off)
        codes, noff, place = _normalised(points, poff)
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(len(off) - 1)]

        def found(doc: int, item: int, distance: int, start: int, end: int) -> None:
            a, b = int(place[noff[doc] + start] - poff[doc]), int(place[noff[doc] + end - 1] + 1 - poff[doc])
            new = (distance, a, b)
            if item not in best[doc] or new < best[doc][item]:
                best[doc][item] = new

        bands = self.candidates(codes, noff)
        for (doc, item, _, _), got in zip(bands, align([
                (self.codes[item], codes[noff[doc]:noff[doc + 1]], low, high, int(self.budget[item]))
                for doc, item, low, high in bands])):
            if got:
                found(doc, item, *got)
        if self.short:
            for doc in range(len(off) - 1):
                text = codes[noff[doc]:noff[doc + 1]]
                whole = " " + "".join(map(chr, text)) + " "
                for item in self.short:
                    at = whole.find(" " + "".join(map(chr, self.codes[item])) + " ")
                    if at >= 0:
                        found(doc, item, 0, at, at + int(self.size[item]))
        return [sorted((self.ids[i], d, a, b) for i, (d, a, b) in x.items()) for x in best]


def _find(item: np.ndarray, text: np.ndarray) -> int:
    """First position of ``item`` in ``text``, -1 if there is none."""
    hay, needle = text.tobytes(), item.tobytes()
    at = hay.find(needle)
    while at >= 0 and at % 4:
        at = hay.find(needle, at + 1)
    return at // 4 if at >= 0 else -1


def align(jobs: list[tuple[np.ndarray, np.ndarray, int, int, int]]) -> list[tuple[int, int, int] | None]:
    """For each (item, text, low, high, budget): best (distance, start, end) of
    the item in the text over alignments that start on a diagonal in
    [low, high] and stay within ``budget`` edits, hence within ``budget``
    diagonals of it; None if there is none.  Jobs run side by side, one row of
    the banded table at a time, and leave once every cell is over budget."""
    out: list[tuple[int, int, int] | None] = [None] * len(jobs)
    rest = []
    for n, (item, text, low, high, budget) in enumerate(jobs):
        a, b = max(0, low - budget), min(len(text), high + budget + len(item) + 1)
        at = _find(item, text[a:b]) if b > a else -1
        if at >= 0:
            out[n] = (0, a + at, a + at + len(item))
        elif b > a and budget:
            rest.append(n)
    rest.sort(key=lambda n: (len(jobs[n][0]), n))
    for i in range(0, len(rest), 64):
        _align_banded(jobs, rest[i:i + 64], out)
    return out


def _align_banded(jobs: list, chosen: list[int], out: list) -> None:
    size = np.array([len(jobs[n][0]) for n in chosen])
    lo = np.array([jobs[n][2] - jobs[n][4] for n in chosen])
    budget = np.array([jobs[n][4] for n in chosen])
    width = int(max(jobs[n][3] - jobs[n][2] + 2 * jobs[n][4] + 1 for n in chosen))
    m = int(size.max())
    bits = width.bit_length()  # a cell: edits << bits | start diagonal
    kind = np.int32 if (m + width + 2) << bits < 1 << 29 else np.int64
    one, far = kind(1 << bits), kind(1 << (29 if kind is np.int32 else 60))
    items = np.zeros((len(chosen), m), np.uint32)
    around = np.zeros((len(chosen), width + m), np.uint32)  # 0: no character there
    for r, n in enumerate(chosen):
        item, text = jobs[n][:2]
        items[r, :len(item)] = item
        a, b = max(0, int(lo[r])), min(len(text), int(lo[r]) + width + m)
        around[r, a - int(lo[r]):b - int(lo[r])] = text[a:b]
    step = np.arange(width, dtype=kind) * one
    cell = np.tile(np.arange(width, dtype=kind), (len(chosen), 1))
    begin = np.arange(width) + lo[:, None]
    cell[(begin < 0) | (begin > np.array([len(jobs[n][1]) for n in chosen])[:, None])] = far
    alive = np.arange(len(chosen))
    for i in range(m):
        there = around[alive, i:i + width]
        nxt = cell + (there != items[alive, i][:, None]) * one
        nxt[there == 0] = far
        np.minimum(nxt[:, :-1], cell[:, 1:] + one, out=nxt[:, :-1])
        nxt -= step
        np.minimum.accumulate(nxt, axis=1, out=nxt)
        nxt += step
        np.minimum(nxt, far, out=nxt)
        cell = nxt
        ended = size[alive] == i + 1
        for r in np.flatnonzero(ended):
            n = chosen[alive[r]]
            d = int(np.argmin(cell[r] >> bits))
            least, start, end = int(cell[r, d]) >> bits, int(cell[r, d]) & int(one - 1), i + 1 + d
            if least <= jobs[n][4] and start < end and end + int(lo[alive[r]]) <= len(jobs[n][1]):
                out[n] = (least, start + int(lo[alive[r]]), end + int(lo[alive[r]]))
        stay = ~ended
        if i % 8 == 7:
            stay &= (cell.min(axis=1) >> bits) <= budget[alive]
        if not stay.all():
            alive, cell = alive[stay], cell[stay]
            if not len(alive):
                return


def _index(items: Items) -> Index:
    return held(("items", items), lambda: Index(items))


def _matched(batch: pa.RecordBatch, index: Index, keep: list[str], text_col: str) -> Iterator[pa.RecordBatch]:
    """The first columns of ``batch``, named ``keep``, with ``matches``."""
    for part in slices(batch, text_col, TEXT_BYTES):
        got = index.matches(*utf8_parts(part.column(part.schema.get_field_index(text_col))))
        rows = [[dict(zip(("item_id", "distance", "start", "end"), x)) for x in r] for r in got]
        yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))]
                                         + [pa.array(rows, MATCH_ARROW)], names=keep + ["matches"])


def _scan(docs: DataFrame, items: Items, text_col: str) -> DataFrame:
    keep = [c for c in docs.columns if c != "matches"]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("matches", T.ArrayType(MATCH))])
    shipped = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shipped.value)
        for batch in batches:
            yield from _matched(batch, index, keep, text_col)
        give_back()

    return docs.select(*keep).mapInArrow(run, schema)


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", rate: float = RATE, block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with ``matches``: the benchmark items found in each text."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).filter(
        "i is not null and t is not null")
    total = items.agg(F.sum(F.char_length("t")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_chars) or 1
    if not total:
        return docs.withColumn("matches", F.array().cast(T.ArrayType(MATCH)))

    def block(b: int) -> Items:
        rows = sorted(tuple(r) for r in items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect())
        return Items(tuple(i for i, _ in rows), tuple(t for _, t in rows), rate)

    if blocks == 1:
        return _scan(docs, block(0), text_col)
    # Each pass over the texts stores its few matches, so a task holds one block's index.
    key = [F.xxhash64(text_col).alias("__k1"), F.hash(F.lit(1), F.col(text_col)).alias("__k2")]
    texts = docs.select(F.col(text_col).alias("__t"), *key)
    found = None
    for b in range(blocks):
        mine = _scan(texts, block(b), "__t").filter(F.size("matches") > 0).dropDuplicates(["__k1", "__k2"])
        mine = stored(mine.select("__k1", "__k2", "matches"), "matches")
        found = mine if found is None else found.unionByName(mine)
    found = found.groupBy("__k1", "__k2").agg(F.array_sort(F.flatten(F.collect_list("matches"))).alias("__m"))
    keep = [c for c in docs.columns if c != "matches"]
    out = docs.select(*keep, *key).join(checked_broadcast(stored(found, "found")), ["__k1", "__k2"], "left")
    return out.select(*keep, F.coalesce("__m", F.array().cast(T.ArrayType(MATCH))).alias("matches"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, sf_dir, "benchmark")).filter(F.size("matches") > 0)
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", "m.item_id", "m.distance", F.col("m.start").alias("start_char"), F.col("m.end").alias("end_char"))
