"""Document fingerprints by one-permutation MinHash.

Every run of ``SHINGLE`` bytes of a text is hashed once; the hash chooses one of
``BINS`` bins and the least hash of a bin is kept.  Empty bins are filled by
optimal densification: bin i asks the bins of a fixed pseudo-random sequence
of its own until one is not empty, and takes that bin's value, so every text
with anything in it has all bins filled and equal bins still meet with the
probability of the Jaccard similarity.  The low ``BITS`` bits of each bin are
packed and printed as hex; :func:`likeness` corrects the share of agreeing
bins for chance agreement of so few bits.

A text shorter than a shingle is a single shingle; the fingerprint of an empty
text is empty, and its likeness to anything but another empty text is 0.

:func:`with_next` finds for each document the next by ascending id (ties: by
the hash of the text, xxhash64) without a global sort in one task: ids are cut into ranges at quantiles,
an id that fills several of them by that hash as well, each range is one group of rows in order, and the first document of a range is
also sent to the range before, where it only serves as a successor.  Null ids
sort first.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.common import SLICE_BYTES, mix, n_shuffle, table

SHINGLE, BINS, BITS = 9, 256, 4
_ASKS = 64  # questions of a bin before a linear search, which ends the rare rest


def _shingle_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the SHINGLE bytes from each position (SHINGLE is 9: one word and a byte)."""
    n = len(raw) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    word = np.ndarray((n,), "<u8", raw.tobytes(), strides=(1,))
    return mix(word * np.uint64(0x9E3779B97F4A7C15) + raw[SHINGLE - 1:])


_SEQUENCE = (mix(np.arange(BINS * _ASKS, dtype=np.uint64) + np.uint64(0xB1A5)) % np.uint64(BINS)).astype(
    np.int64).reshape(_ASKS, BINS)


def _densified(least: np.ndarray) -> np.ndarray:
    """Fill empty bins (the largest value) of every row that has a full one."""
    empty = np.iinfo(np.uint64).max
    out = least.copy()
    some = (least != empty).any(axis=1)
    r, b = np.nonzero((least == empty) & some[:, None])
    for ask in range(_ASKS):
        if not len(r):
            return out
        got = least[r, _SEQUENCE[ask, b]]
        full = got != empty
        out[r[full], b[full]] = got[full]
        r, b = r[~full], b[~full]
    for step in range(1, BINS):
        got = least[r, (_SEQUENCE[0, b] + step) % BINS]
        full = got != empty
        out[r[full], b[full]] = got[full]
        r, b = r[~full], b[~full]
    return out


def bins(texts: list[bytes]) -> np.ndarray:
    """Low bits of the filled bins of each text, [text, BINS] of uint8."""
    out = np.zeros((len(texts), BINS), np.uint8)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        least = np.full((end - at) * BINS, np.iinfo(np.uint64).max, np.uint64)
        raw = np.frombuffer(b"".join(texts[at:end]), np.uint8)
        sizes = np.array([len(t) for t in texts[at:end]])
        h = _shingle_hashes(raw)
        if len(h):
            doc = np.repeat(np.arange(end - at), sizes)[:len(h)]
            inside = np.arange(len(h)) + SHINGLE <= np.cumsum(sizes)[doc]
            h, doc = h[inside], doc[inside]
            np.minimum.at(least, doc * BINS + (h >> np.uint64(56)).astype(np.int64), h)
        for i in np.flatnonzero((sizes < SHINGLE) & (sizes > 0)):
            own = int.from_bytes(hashlib.blake2b(texts[at + i], digest_size=8).digest(), "big")
            least[i * BINS + (own >> 56)] = own
        full = _densified(least.reshape(-1, BINS))
        out[at:end] = mix(full).astype(np.uint8) & np.uint8((1 << BITS) - 1)
        at = end
    return out


def packed(low: np.ndarray, texts: list[bytes]) -> list[str]:
    """Hex of the packed bins; empty for an empty text."""
    pairs = (low[:, 0::2] << 4) | low[:, 1::2]
    return [p.tobytes().hex() if t else "" for p, t in zip(pairs, texts)]


def likeness(a: np.ndarray, b: np.ndarray, full_a: np.ndarray, full_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity row by row: the share of agreeing bins, less
    what ``BITS`` bits agree by chance."""
    chance = 2.0 ** -BITS
    got = np.maximum(0.0, ((a == b).mean(axis=1) - chance) / (1 - chance))
    return np.where(full_a & full_b, got, (full_a == full_b).astype(float))


def _limits(quantiles: list[int]) -> list[tuple[int, int]]:
    """First (id, hash of text) of each range but the first.  An id that fills
    several quantiles (null ids, say) is split evenly by the hash of its texts."""
    return [(x, -(1 << 63) + (j << 64) // n) for x, n in sorted(Counter(int(q) for q in quantiles).items())
            for j in range(n)]


def _limits_at_or_below(limits: list[tuple[int, int]], order: Column, tie: Column) -> Column:
    """Number of limits at or below a row's (order, tie), by binary search in a
    folded literal: plan and work a row grow with the logarithm of the ranges."""
    if not limits:
        return F.lit(0)
    ids, ties = (F.split(F.lit(",".join(map(str, part))), ",").cast("array<long>") for part in zip(*limits))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(limits).bit_length()))])

    def step(at: Column, size: Column) -> Column:
        o, t = F.get(ids, at + size - 1), F.get(ties, at + size - 1)  # null beyond the last limit
        return F.when((o < order) | ((o == order) & (t <= tie)), at + size).otherwise(at)

    return F.reduce(steps, F.lit(0), step)


def with_next(docs: DataFrame, text_col: str, id_col: str, ranges: int) -> DataFrame:
    """Rows (range, place, successor, id, text) to be read in order of place
    within a range; ``successor`` marks the copies that only follow others."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order, tie = F.coalesce(F.col("id"), F.lit(-(1 << 63))), F.xxhash64("text")
    quantiles = (d.select(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 10_000).alias("q"))
                 .first()["q"] or []) if ranges > 1 else []
    which = _limits_at_or_below(_limits(quantiles), order, tie)
    heads = (d.select(which.alias("r"), F.struct(order.alias("o"), tie.alias("t")).alias("k"))
             .groupBy("r").agg(F.min("k").alias("k")).collect())
    firsts = sorted((x["r"], x["k"]["o"], x["k"]["t"]) for x in heads)
    if not firsts:
        return d.select(F.lit(0).alias("r"), F.lit(0).alias("wrap"), order.alias("o"), tie.alias("t"),
                        F.lit(False).alias("successor"), "id", "text")
    # The first row of each range also goes to the range before it (of the first: to the last).
    targets = F.broadcast(docs.sparkSession.createDataFrame(
        [(o, t, firsts[i - 1][0], int(i == 0)) for i, (_, o, t) in enumerate(firsts)],
        "o long, t long, target int, wrap int"))  # one row per range
    own = F.struct(F.col("r"), F.lit(0).alias("wrap"), F.lit(False).alias("successor"))
    copy = F.struct(F.col("target").alias("r"), F.col("wrap"), F.lit(True).alias("successor"))
    return (d.withColumn("o", order).withColumn("t", tie).withColumn("r", which).join(targets, ["o", "t"], "left")
            .withColumn("x", F.explode(F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, copy))))
            .select("x.r", "x.wrap", "o", "t", "x.successor", "id", "text"))


OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
                    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
                    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
                    T.StructField("near_next", T.DoubleType())])


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Output of consecutive (range, id, text, successor); the last one only follows."""
    own = [r[2].encode() for r in rows]
    changed = [edited(a[2], b[2]).encode() for a, b in zip(rows[:-1], rows[1:])]
    low, low_changed = bins(own), bins(changed)
    full = np.array([len(t) > 0 for t in own])
    full_changed = np.array([len(t) > 0 for t in changed], bool)
    return pa.RecordBatch.from_arrays([
        pa.array([r[1] for r in rows[:-1]], pa.int64()), pa.array([len(r[2]) for r in rows[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        pa.array(packed(low[:-1], own[:-1]), pa.string()), pa.array(packed(low_changed, changed), pa.string()),
        pa.array(likeness(low[:-1], low_changed, full[:-1], full_changed)),
        pa.array(likeness(low[:-1], low[1:], full[:-1], full[1:]))], names=OUT.names)


def compare_with_next(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                      ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness to
    each other and to the next document's."""
    ranges = ranges or 4 * n_shuffle(docs.sparkSession)
    d = with_next(docs, text_col, id_col, ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # consecutive rows of one range, not yet compared but for the last
        size = 0
        for batch in batches:
            for r, i, text, successor in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held and held[-1][0] != r:
                    if len(held) > 1:
                        yield _compared(held)
                    held, size = [], 0
                if held and held[-1][3]:
                    continue  # a second successor: the first one, an equal row, has served
                held.append((r, i, text, successor))
                size += len(text)
                if size > SLICE_BYTES:
                    if len(held) > 1:
                        yield _compared(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield _compared(held)

    ordered = (d.repartition(n_shuffle(docs.sparkSession), "r")
               .sortWithinPartitions("r", "wrap", "o", "t", "successor").select("r", "id", "text", "successor"))
    return ordered.mapInArrow(run, OUT)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
