"""Ranked lexical search over a document FP-tree with branch and bound.

Terms are the maximal runs of characters other than ASCII ones that are neither
letter nor digit; only A-Z are lower-cased.  N counts the documents with a term, L all
their terms, n one document's terms, df the documents that hold a term, tf its
occurrences in the document.  A term weighs w = floor(1000 * ln((2N + 2) / (2 df + 1)));
a document has m = 75 + (25 n N) div L.  The score of a document for an item is
the sum over the item's terms, repeats included, of
w * ((1000000000 tf) div (1000 tf + 12 m)), all in integers.  Every item gets its
``k`` highest scores above 0, equal ones by ascending id.

One pass over the documents keeps of each its length and its vector of item
terms with tf; df, N and L are sums over those.  Then every task builds FP-trees
of its documents: vectors in order of falling df, sorted, so that documents
share the paths of their common prefixes; a node has for its subtree the
largest tf of each term and the smallest m.  Both make a score no smaller, so the score of a
node as if it were a document bounds every document below.  The walk is depth
first and serves all items at once, each with a bound of its own: a subtree in
which no item can still reach its k-th best score is left out.  A task gives at most
``k`` rows per item, of which a window keeps the best.

Items are taken in blocks of about ``block_bytes`` of text, one search per
block, so what is broadcast is bounded whatever the number of items.

Edge cases: a null or term-less text, of a document or an item, has no match
and does not count in N.  Each row is a document and each row an item: rows
that repeat an id rank one by one.  Null ids come after all others of the same score.
Only the named columns are used.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import slices, stored, table, utf8_parts

K, BLOCK_BYTES = 20, 1 << 20
CHUNK = 1 << 20  # vector entries of one tree
BUCKET = 16  # documents that a leaf scores together
_INSIDE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and number of every term, and the distinct terms by number."""
    raw, off = utf8_parts(pc.ascii_lower(texts))
    inside = _INSIDE[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    begin[heads] = inside[heads]
    first = np.flatnonzero(begin)
    before = np.concatenate([[0], np.cumsum(inside)])
    offsets = np.append(before[first], before[-1]).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    coded = array.dictionary_encode()
    return (np.searchsorted(off, first, side="right") - 1, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            coded.dictionary)


@dataclass
class Items:
    """Items with their terms: (item, term, times) in rising order of the term."""
    ids: list
    vocabulary: pa.Array
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray


def indexed(ids: list, texts: list) -> Items:
    doc, word, distinct = terms(pa.array(texts, pa.string()))
    pair, times = np.unique(word * max(len(ids), 1) + doc, return_counts=True)
    return Items(ids, distinct, pair % max(len(ids), 1), pair // max(len(ids), 1), times.astype(np.int64))


class Scorer:
    """Scores of sparse vectors for all items of a block; terms by rank, the
    term of most documents first."""

    def __init__(self, items: Items, df: np.ndarray, n_docs: int):
        self.rank = np.empty(len(df), np.int64)
        self.rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        at = self.rank[items.term]
        order = np.argsort(at, kind="stable")
        self.item, self.gain = items.item[order], (items.times * weight[items.term])[order]
        self.first = np.searchsorted(at[order], np.arange(len(df) + 1))
        self.n_items = len(items.ids)
        # No score exceeds this; below 2^53 doubles add up exactly.
        self.exact = int(np.bincount(self.item, weights=self.gain, minlength=1).max(initial=0)) * 1_000_000 < 1 << 52

    def __call__(self, row: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, rows: int) -> np.ndarray:
        """[row, item] scores of vectors given as entries (row, rank, tf), m by row."""
        part = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
        span = self.first[rank + 1] - self.first[rank]
        entry = np.repeat(self.first[rank] - np.cumsum(span) + span, span) + np.arange(span.sum())
        key = np.repeat(row, span) * self.n_items + self.item[entry]
        gain = np.repeat(part, span) * self.gain[entry]
        if self.exact:
            out = np.bincount(key, weights=gain, minlength=rows * self.n_items).astype(np.int64)
        else:
            out = np.zeros(rows * self.n_items, np.int64)
            np.add.at(out, key, gain)
        return out.reshape(rows, self.n_items)


class Tree:
    """FP-tree of documents given as CSR rows of (rank, tf), with m by document."""

    def __init__(self, ids: list, m: np.ndarray, first: np.ndarray, rank: np.ndarray, tf: np.ndarray, n_ranks: int, k: int = K):
        order = np.lexsort((rank, np.repeat(np.arange(len(m)), np.diff(first))))
        rank, tf = rank[order], tf[order]
        raw, raw_tf = rank.astype(">u4"), tf.astype(">u8")
        twins: dict[tuple, list] = {}
        for i in range(len(m)):  # documents of the same vector and m are one leaf
            a, b = first[i], first[i + 1]
            twins.setdefault((raw[a:b].tobytes(), raw_tf[a:b].tobytes(), int(m[i])), []).append(i)
        leaves = [(key[0], own) for key, own in sorted(twins.items())]
        # Of equal leaves only the k smallest ids can rank.
        self.ids = [heapq.nsmallest(k, (ids[i] for i in own), key=lambda x: (x is None, x or 0)) for _, own in leaves]
        stands = np.array([own[0] for _, own in leaves], np.int64)
        size = np.diff(first)[stands]
        self.first = np.concatenate([[0], np.cumsum(size)])
        entry = np.repeat(first[stands] - self.first[:-1], size) + np.arange(self.first[-1])
        self.rank, self.tf, self.m = rank[entry], tf[entry], m[stands]
        shared = np.zeros(len(leaves) + 1, np.int64)  # length of the prefix a leaf shares with the one before
        for i in range(1, len(leaves)):
            n = min(size[i - 1], size[i])
            a, b = self.first[i - 1], self.first[i]
            unlike = self.rank[a:a + n] != self.rank[b:b + n]
            shared[i] = unlike.argmax() if unlike.any() else n
        # A node: its leaves, and for all below it terms, largest tf, smallest m; its children or none.
        self.nodes: list[tuple] = []
        self.root = self._grow(shared, n_ranks) if leaves else None
        self.scored = 0

    def _grow(self, shared: np.ndarray, n_ranks: int) -> int:
        most = np.zeros(n_ranks, np.int64)

        def node(lo: int, hi: int) -> int:
            a, b = self.first[lo], self.first[hi]
            np.maximum.at(most, self.rank[a:b], self.tf[a:b])
            used = np.unique(self.rank[a:b])
            self.nodes.append((lo, hi, used, most[used].copy(), self.m[lo:hi].min(), []))
            most[used] = 0
            return len(self.nodes) - 1

        root = node(0, len(self.ids))
        todo = [root]
        while todo:
            at = todo.pop()
            lo, hi, *_, below = self.nodes[at]
            if hi - lo <= BUCKET:
                continue
            inner = shared[lo + 1:hi]
            cuts = [lo, *(lo + 1 + np.flatnonzero(inner == inner.min())), hi]
            start = lo
            for a, b in zip(cuts, cuts[1:]):
                # Branches of few leaves side by side make one bucket.
                if b - start > BUCKET and start < a:
                    below.append(node(start, a))
                    start = a
                if b - a > BUCKET:
                    below.append(node(a, b))
                    todo.append(below[-1])
                    start = b
            if start < hi:
                below.append(node(start, hi))
        return root

    def search(self, scorer: Scorer, best: Best) -> None:
        """Depth-first branch and bound; what it finds goes to ``best``."""
        todo = [] if self.root is None else [self.root]
        while todo:
            lo, hi, rank, tf, m, below = self.nodes[todo.pop()]
            bound = scorer(np.zeros(len(rank), np.int64), rank, tf, np.array([m]), 1)[0]
            if not (bound >= best.least).any():
                continue
            if below:
                todo.extend(reversed(below))
                continue
            a, b = self.first[lo], self.first[hi]
            row = np.repeat(np.arange(hi - lo), np.diff(self.first[lo:hi + 1]))
            scores = scorer(row, self.rank[a:b], self.tf[a:b], self.m[lo:hi], hi - lo)
            self.scored += hi - lo
            for i, item in zip(*np.nonzero(scores >= best.least)):
                for doc in self.ids[lo + i]:
                    best.offer(int(item), int(scores[i, item]), doc)


class Best:
    """The k best of each item, and the least score that still matters."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.heaps: list[list] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def offer(self, item: int, score: int, doc: int | None) -> None:
        heap, row = self.heaps[item], (score, doc is not None, -(doc or 0))
        if len(heap) < self.k:
            heapq.heappush(heap, row)
        elif row > heap[0]:
            heapq.heapreplace(heap, row)
        if len(heap) == self.k:
            self.least[item] = heap[0][0]


def _vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(id, n, term, tf): of each document its terms in all and its vector of vocabulary terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                doc, word, distinct = terms(part.column(1))
                number = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                term = number[word] if len(word) else word
                kept = term >= 0
                pair, tf = np.unique(doc[kept] * max(len(known), 1) + term[kept], return_counts=True)
                owner = pair // max(len(known), 1)
                off = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.bincount(doc, minlength=part.num_rows).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(off), pa.array((pair % max(len(known), 1)).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(off), pa.array(tf.astype(np.int64)))], names=["id", "n", "term", "tf"])

    return docs.mapInArrow(run, "id long, n long, term array<int>, tf array<long>")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in vectors.select("term").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]  # at most the block's vocabulary
    return out


def _lengths(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """m of documents by their length."""
    if int(n.max(initial=0)) * 25 * n_docs < 1 << 63:
        return 75 + 25 * n * n_docs // total
    return np.array([75 + 25 * int(x) * n_docs // total for x in n], np.int64)


def _searched(vectors: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, item_id, id, score): per task at most k rows of each item."""
    sums = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, total = sums["docs"], sums["terms"] or 0
    scorer = Scorer(items, _document_counts(vectors, len(items.vocabulary)), n_docs)
    shared = vectors.sparkSession.sparkContext.broadcast((scorer, items.ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, ids = shared.value
        best = Best(len(ids), k)
        held: list[pa.RecordBatch] = []

        def grown() -> None:
            if held:
                rows = pa.Table.from_batches(held).combine_chunks()
                term, tf = rows.column("term").combine_chunks(), rows.column("tf").combine_chunks()
                size = pc.list_value_length(term).to_numpy(zero_copy_only=False).astype(np.int64)
                tree = Tree(rows.column("id").to_pylist(), _lengths(rows.column("n").to_numpy(), n_docs, total),
                            np.concatenate([[0], np.cumsum(size)]), scorer.rank[term.flatten().to_numpy()],
                            tf.flatten().to_numpy(), len(scorer.rank), k)
                tree.search(scorer, best)
                held.clear()

        entries = 0
        for batch in batches:
            size = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            piece = np.cumsum(size) // CHUNK
            for number in np.unique(piece):
                a, b = np.searchsorted(piece, [number, number + 1])
                held.append(batch.slice(a, b - a))
                entries += int(size[a:b].sum())
                if entries >= CHUNK:
                    grown()
                    entries = 0
        grown()
        rows = [(i, ids[i], -d if known else None, s) for i, heap in enumerate(best.heaps) for s, known, d in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(
            (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["item", "item_id", "id", "score"])

    return vectors.filter(F.size("term") > 0).mapInArrow(run, "item int, item_id long, id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, text_col: str = "text", id_col: str = "doc_id",
           item_text_col: str = "text", item_id_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), the document's id and score."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    q = items.select(F.col(item_id_col).cast("long").alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    size = q.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    q = q.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        rows = q.filter(F.col("block") == b).collect()  # one block of items
        mine = indexed([r["id"] for r in rows], [r["text"] for r in rows])
        vectors = stored(_vectors(d, mine.vocabulary), "vectors")
        found = _searched(vectors, mine, k).withColumn("block", F.lit(b))
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", F.col("id").alias(id_col), "score"))


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
