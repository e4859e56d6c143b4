"""Vector compression to one code per part, by a trie over distinct parts.

A component x becomes the integer floor(scale * x).  A vector is cut into
``parts`` equal consecutive parts; every part position has a codebook of up to
``entries`` entries, which starts as that part of the smallest ids.  A round
assigns each part to its nearest entry (squared Euclidean distance, ties to the
lower index) and replaces each entry by the componentwise floor(sum / count) of
its parts; an entry without parts stays.  After ``rounds`` rounds parts are
assigned once more, which gives codes and errors.

Equal parts are counted once: the distinct parts of the corpus are stored with
their counts, in lexicographic order of their components, dealt by range.  Read
in that order they are the leaves of a trie, walked depth first: the distances
from a prefix to all entries are summed once for every part below it, a leaf
takes the argmin of its row and adds count times part to its entry.  The walk
goes leaf block by leaf block, keeps the sums along the last path and works out
the new nodes of one depth of a block together.  Per task only sums by entry
leave, so a vector that makes up a third of all rows is one leaf.

Edge cases: rows whose vector is null or holds null, NaN or infinities are
dropped.  Fewer rows than ``entries`` give a shorter codebook, no rows an empty
result.  Ids that repeat are ordered by their components, null ids come last.
A vector shorter than the longest one, or a length that ``parts`` does not
divide, is filled up with zeros at its end.  Scaled components are limited to
+-2^24, so that distances fit 64 bits.  Only the named columns are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import n_shuffle, stored, table
from tripcast.operators.broadcast import checked_broadcast

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 1 << 24
LEAVES = 512  # leaves worked on together; a depth holds LEAVES x ENTRIES sums


def quantised(vectors: pa.Array, dim: int, scale: int = SCALE) -> np.ndarray:
    """Integer components [row, dim] of vectors without nulls."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    out = np.zeros((len(size), dim), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = np.clip(np.floor(flat * scale), -LIMIT, LIMIT).astype(np.int64)
    return out


def _packed(part: np.ndarray) -> pa.Array:
    """Rows of integers as bytes that sort like the rows."""
    n, p = part.shape
    data = (part + LIMIT).astype(">u4").tobytes()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * 4 * p).astype(np.int32)), pa.py_buffer(data)])


def _unpacked(keys: pa.Array, p: int) -> np.ndarray:
    joined = b"".join(keys.to_pylist())
    return np.frombuffer(joined, ">u4").astype(np.int64).reshape(len(keys), p) - LIMIT


class Trie:
    """Depth-first walk over parts in lexicographic order against one codebook
    [entry, component].  Parts out of order cost more and give the same."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.widest = int(np.abs(book).max(initial=0))
        self.path: np.ndarray | None = None  # the last leaf
        self.sums = np.zeros((book.shape[1] + 1, len(book)), np.int64)  # distances of its prefixes to every entry
        self.nodes = 0

    def nearest(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part."""
        code, far = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for a in range(0, len(part), LEAVES):
            code[a:a + LEAVES], far[a:a + LEAVES] = self._block(part[a:a + LEAVES])
        return code, far

    def _block(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, p = part.shape
        widest = max(self.widest, int(np.abs(part).max(initial=0)))
        kind = np.float64 if p * (2 * widest) ** 2 < 1 << 53 else np.int64  # doubles are faster where they are exact
        book = self.book.astype(kind)
        fresh = np.ones((n, p), bool)  # does the leaf part from the one before at or above this depth?
        fresh[1:] = np.logical_or.accumulate(part[1:] != part[:-1], axis=1)
        if self.path is not None:
            fresh[0] = np.logical_or.accumulate(part[0] != self.path)
        node = np.zeros(n, np.int64)  # node 0 of a depth is the one the last path went through
        sums = self.sums[0].astype(kind)[None, :]
        for d in range(p):
            new = np.flatnonzero(fresh[:, d])
            step = part[new, d].astype(kind)[:, None] - book[None, :, d]
            np.multiply(step, step, out=step)
            step += sums[node[new]]
            sums = np.concatenate([self.sums[d + 1].astype(kind)[None, :], step])
            node = np.cumsum(fresh[:, d])
            self.nodes += len(new)
            self.sums[d + 1] = sums[-1]
        self.path = part[-1]
        code = sums.argmin(axis=1)
        return code[node], sums[np.arange(len(sums)), code].astype(np.int64)[node]


def _usable(vectors: DataFrame, vec_col: str, id_col: str, label_col: str | None) -> DataFrame:
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"), label.alias("label"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return v.filter(F.col("v").isNotNull() & ~F.coalesce(F.exists("v", odd), F.lit(True)))


def _distinct_parts(usable: DataFrame, dim: int, parts: int, scale: int) -> DataFrame:
    """(pos, part, n) in lexicographic order, dealt by range."""
    p = dim // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = quantised(batch.column(0), dim, scale)
                for k in range(parts):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(whole), k, np.int32)), _packed(whole[:, k * p:(k + 1) * p])],
                                                     names=["pos", "part"])

    found = usable.select("v").mapInArrow(run, "pos int, part binary").groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n"))
    return found.repartitionByRange(n_shuffle(usable.sparkSession), "pos", "part").sortWithinPartitions("pos", "part")


def _moved(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks [pos, entry, component] after one round."""
    parts, entries, p = books.shape
    shared = distinct.sparkSession.sparkContext.broadcast(books)  # the model itself: parts x entries x components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [Trie(b) for b in shared.value]
        total, count = np.zeros((parts, entries, p), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            pos, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for k in np.unique(pos):
                at = np.flatnonzero(pos == k)
                part = _unpacked(batch.column(1).take(pa.array(at)), p)
                code, _ = tries[k].nearest(part)
                np.add.at(count[k], code, n[at])
                if int(n[at].sum()) < 1 << 34:  # weighted sums fit 64 bits
                    inside = np.zeros((entries, p), np.int64)
                    np.add.at(inside, code, part * n[at, None])
                    total[k] += inside
                else:
                    for c, row, m in zip(code, part, n[at]):
                        total[k, c] += row.astype(object) * int(m)
        pos, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(pos, p).astype(np.int32)), pa.array(np.repeat(entry, p).astype(np.int32)),
            pa.array(np.tile(np.arange(p), len(pos)).astype(np.int32)), pa.array(np.repeat(count[pos, entry], p)),
            pa.array([str(x) for x in total[pos, entry].ravel()], pa.string())], names=["pos", "entry", "i", "n", "total"])

    rows = (distinct.mapInArrow(run, "pos int, entry int, i int, n long, total string").groupBy("pos", "entry", "i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect())
    out = books.copy()
    for r in rows:  # at most parts x entries x components
        out[r["pos"], r["entry"], r["i"]] = int(r["total"]) // r["n"]
    return out


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def compress(vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", label_col: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every usable vector, code as one hexadecimal
    number of equal width per part, and the final codebooks [part, entry, component]."""
    usable = _usable(vectors, vec_col, id_col, label_col)
    dim = usable.agg(F.max(F.size("v"))).first()[0] or 0
    dim = -(-max(dim, 1) // parts) * parts
    p, digits = dim // parts, len(f"{max(entries - 1, 0):x}")
    first = usable.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    books = quantised(first.column("v"), dim, scale).reshape(-1, parts, p).transpose(1, 0, 2).copy()
    kind = f"id {vectors.schema[id_col].dataType.simpleString()}, label {usable.schema['label'].dataType.simpleString()}, code string, error long"
    if not books.shape[1]:
        return vectors.sparkSession.createDataFrame([], kind), books
    distinct = stored(_distinct_parts(usable, dim, parts, scale), "parts")
    for _ in range(rounds):
        books = _moved(distinct, books)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = quantised(batch.column(1), dim, scale)
            error, text = np.zeros(len(whole), np.int64), [""] * len(whole)
            for k in range(parts):
                mine = whole[:, k * p:(k + 1) * p]
                order = np.lexsort(mine.T[::-1])
                code, far = Trie(shared.value[k]).nearest(mine[order])
                error[order] += far
                for i, c in zip(order, code):
                    text[i] += f"{c:0{digits}x}"
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(text, pa.string()), pa.array(error)],
                                             names=["id", "label", "code", "error"])

    return usable.select("id", "v", "label").mapInArrow(run, kind), books


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    coded = stored(coded, "codes")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    sums = sums.withColumnRenamed("label", "l")
    out = coded.join(checked_broadcast(sums), F.col("label").eqNullSafe(F.col("l")))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), "label")
