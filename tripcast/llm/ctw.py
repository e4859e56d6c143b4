"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes and an end mark; the context of a byte is the
``DEPTH`` bytes before it (the start of a text counts as marks, a byte that
UTF-8 never uses).  A byte is eight binary decisions, each a node of the byte's
binary tree with a context tree of its own.  A tree node of depth d has the
counts of zeros and ones seen in its context, their Krichevsky-Trofimov block
probability Pe, and the weighted probability Pw = (Pe + product of the
children's Pw) / 2, at full depth Pw = Pe.  The probability of a bit mixes the
Krichevsky-Trofimov estimates (ones + 1/2) / (n + 1) of all depths with the
posterior weights Pe / (Pe + product of children) along the path.  A node not
seen in training gives 1/2.

All training texts count.  Rows are sealed, as they come, into blocks of about
``block_bytes`` of text.  A block reports its distinct runs of DEPTH + 1 bytes
with training counts, and its distinct words, packed into one row per group
(sorted, delta-coded, compressed); a group merges the rows of all blocks, so no
task ever holds the vocabulary or the model, and what a block needs comes back
packed.  Groups of runs hold whole subtrees of the last
two context bytes, cut by the third byte back into ``salts`` parts where groups are
many, so the largest subtree does not end up in one task.  Depths 0 to
TOP are summed over the groups and pass through the driver: at most 255 nodes for each
pair of bytes, whatever the input.

``base_score`` is that of a unigram model of words: sum over tokens of
log10((c + 0.1) / (N + 0.1 * (V + 1))); A-Z are lower-cased, tokens are runs of
bytes other than 0x20 and 0x09-0x0D, and one end token per text.

Edge cases: null text is empty (one end token, one end mark).  Without
training texts every byte costs eight bits.  Repeated rows are scored one by
one; other columns are not used.  A text longer than a block is a block by
itself and is worked through in pieces of PIECE bytes.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import Scratch, give_back, hold_memory, id_mod, mix, n_shuffle, stored, table, utf8_parts

DEPTH, TOP, BLOCK_BYTES, GROUP_BYTES, MARK = 6, 2, 16 << 20, 4 << 20, 0xFF
PIECE = 1 << 20  # bytes whose runs are held at once; a run takes some 60 bytes meanwhile
SORTED_PIECES = 6  # pieces whose runs are sorted together
GROUPS_PER_SALT = 32
VALUE_UNIT = 2.0 ** -38  # of log probabilities on their way back to a block
_SMALL = 4096  # counts up to here have their log gamma looked up
_LN2 = math.log(2)
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_PLACES = np.arange(PIECE, dtype=np.uint64)


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0: Stirling's series behind eight steps up."""
    x = np.asarray(x, float)
    low = x < 8
    y = np.where(low, x + 8, x)
    shift = np.zeros_like(y)
    if low.any():
        z = np.where(low, x, 1.0)
        product = np.ones_like(y)
        for k in range(8):
            product = product * (z + k)
        shift = np.where(low, np.log(product), 0.0)
    s = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + s - shift


@functools.cache
def _looked_up(add: float) -> np.ndarray:
    return lgamma(np.arange(_SMALL) + add)


def _lgamma_of(count: np.ndarray, add: float) -> np.ndarray:
    """log gamma(count + add) of counts, from a table where they are small."""
    out = _looked_up(add)[np.minimum(count, _SMALL - 1)]
    large = np.flatnonzero(count >= _SMALL)
    if len(large):
        out[large] = lgamma(count[large] + add)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of integer counts."""
    return _lgamma_of(zeros, 0.5) + _lgamma_of(ones, 0.5) - _lgamma_of(zeros + ones, 1.0) - math.log(math.pi)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -700, 700)))


# --- Packing -------------------------------------------------------------------

def _packed(x: np.ndarray) -> bytes:
    """Eight-byte numbers, like bytes side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes, kind=np.int64) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(kind).ravel()


def _rising(x: np.ndarray) -> bytes:
    """Packed rising integers."""
    return _packed(np.diff(x, prepend=np.int64(0)))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _sealed(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        for batch in batches:
            writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """(block, n_bytes, docs): the rows (id, text, train) in sealed blocks, without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | made]), pa.array([size], pa.int64()),
                                               pa.array([_sealed(held)], pa.binary())], names=["block", "n_bytes", "docs"])

        for batch in batches:
            _, off = utf8_parts(batch.column(1))
            off = off + 16 * np.arange(len(off))  # an empty text takes room as well
            at = 0
            while at < batch.num_rows:
                end = int(np.searchsorted(off, off[at] + block_bytes - size, side="left"))
                end = min(max(end, at + 1), batch.num_rows)
                held.append(batch.slice(at, end - at))
                size += int(off[end] - off[at])
                at = end
                if size >= block_bytes:
                    yield block()
                    made, held, size = made + 1, [], 0
        if held:
            yield block()
        give_back()

    return rows.mapInArrow(run, "block long, n_bytes long, docs binary")


# --- Words and runs of a block -----------------------------------------------------

def _word_cuts(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of the texts that end at white space or with a text, never inside a word."""
    at = 0
    while at < len(raw):
        end = at + 4 * PIECE
        while end < len(raw):
            nearest = int(off[np.searchsorted(off, end, side="right") - 1])  # where the last text in the piece begins
            data = raw[max(at, nearest):end]
            gaps = np.flatnonzero(_SPACE[data])
            cut = max(at, nearest) + int(gaps[-1]) + 1 if len(gaps) else nearest
            if cut > at:
                end = cut
                break
            end += 4 * PIECE  # a word longer than a piece
        end = min(end, len(raw))
        yield at, end
        at = end


def _words(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], pa.Array]:
    """Piece by piece the text and the number of every word, and the distinct words by number."""
    raw, off = utf8_parts(pc.ascii_lower(texts))
    pieces, found = [], []
    for at, end in _word_cuts(raw, off):
        data = raw[at:end]
        inside = ~_SPACE[data]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        heads = off[(off > at) & (off < end)] - at
        begin[heads] = inside[heads]
        stop[heads - 1] = inside[heads - 1]
        first = np.flatnonzero(begin)
        offsets = np.zeros(len(first) + 1, np.int64)
        np.cumsum(np.flatnonzero(stop) - first + 1, out=offsets[1:])
        array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = array.dictionary_encode()
        n = np.diff(np.searchsorted(first, np.clip(off - at, 0, end - at)))  # words of each text in the piece
        pieces.append((np.repeat(np.arange(len(n), dtype=np.int32), n), coded.indices.to_numpy(zero_copy_only=False)))
        found.append(coded.dictionary)
    if not found:
        return [], pa.array([], pa.large_binary())
    joined = pa.concat_arrays(found).dictionary_encode()
    number = joined.indices.to_numpy(zero_copy_only=False)
    first = np.cumsum([0, *map(len, found)])
    return [(doc, number[a:b][word]) for (doc, word), a, b in zip(pieces, first, first[1:])], joined.dictionary


def _run_pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Piece by piece every byte (and end mark) with its context as one number, and its text."""
    raw, off = utf8_parts(texts)
    n = len(off) - 1
    seq = np.full(len(raw) + n * (DEPTH + 1) + DEPTH, MARK, np.uint8)  # DEPTH marks before a text, one behind it
    coded = np.zeros(len(seq), bool)
    begin = off[:-1] + np.arange(n) * (DEPTH + 1) + DEPTH
    size = np.diff(off) + 1
    for i in range(n):
        seq[begin[i]:begin[i] + size[i] - 1] = raw[off[i]:off[i + 1]]
        coded[begin[i]:begin[i] + size[i]] = True
    for a in range(DEPTH, len(seq), PIECE):
        b = min(a + PIECE, len(seq))
        part = seq[a - DEPTH:b].astype(np.int64)
        code, shifted = part[DEPTH:].copy(), np.empty(b - a, np.int64)
        for k in range(1, DEPTH + 1):
            code |= np.left_shift(part[DEPTH - k:-k], 8 * k, out=shifted)
        first, last = np.searchsorted(begin, [a, b])
        first = max(first - 1, 0)
        inside = np.clip(begin[first:last] + size[first:last], a, b) - np.clip(begin[first:last], a, b)
        yield code[coded[a:b]], np.repeat(np.arange(first, last), inside)


def _tallied(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order and the sums of their counts."""
    order = keys.argsort()
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _runs(texts: pa.Array, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of a block in rising order, and how often training texts have each."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[np.ndarray] = []

    def reduced() -> None:
        tagged = np.concatenate(held)  # runs take 56 bits, a training text's are odd
        held.clear()
        tagged.sort()
        first = np.flatnonzero((tagged[1:] ^ tagged[:-1]) > 1) + 1
        first = np.concatenate([[0], first])
        done.append((tagged[first] >> 1, np.add.reduceat(tagged & 1, first)))

    for code, owner in _run_pieces(texts):
        held.append(code << 1 | train[owner])
        if len(held) == SORTED_PIECES:
            reduced()
            if len(done) == 4:
                done = [_tallied(*map(np.concatenate, zip(*done)))]
    if held:
        reduced()
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return done[0] if len(done) == 1 else _tallied(*map(np.concatenate, zip(*done)))


def _together(code: np.ndarray) -> np.ndarray:
    """An order of at most PIECE runs by all but their last bits, so that most equal
    ones are side by side: sorting numbers is much faster than sorting places."""
    bits = PIECE.bit_length() - 1
    high = code.view(np.uint64) >> np.uint64(8 * (DEPTH + 1) + bits - 64)
    high <<= np.uint64(bits)
    high |= _PLACES[:len(code)]
    high.sort()
    high &= np.uint64(PIECE - 1)
    return high.view(np.int64)


def _word_group(words: pa.Array, groups: int) -> np.ndarray:
    """Group of each word by a hash of its bytes and their places."""
    raw, off = utf8_parts(words)
    if not len(words):
        return np.zeros(0, np.int64)
    place = np.arange(len(raw)) - np.repeat(off[:-1], np.diff(off))
    return (mix(np.add.reduceat(mix(raw + (place.astype(np.uint64) << np.uint64(8))), off[:-1])) % np.uint64(groups)).astype(np.int64)


def _run_group(runs: np.ndarray, groups: int, salts: int) -> np.ndarray:
    """Group of a run by its last two context bytes and a part of the third."""
    context = (runs >> 8 & 0xFFFF) | (runs >> 24 & 0xFF) % salts << 16
    return (mix(context.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group with the places that belong to it, in rising order."""
    order = np.argsort(group, kind="stable")
    used, first = np.unique(group[order], return_index=True)
    for g, a, b in zip(used, first, np.append(first[1:], len(order))):
        yield int(g), order[a:b]


def _train_flags(docs: pa.Table) -> np.ndarray:
    return docs.column("train").to_numpy(zero_copy_only=False).astype(np.int64)


def _texts(docs: pa.Table) -> pa.Array:
    column = docs.column("text")
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _feature_rows(block: int, parts: list[tuple[int, bytes, bytes]], what: str) -> pa.RecordBatch:
    group, keys, n = zip(*parts)
    return pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array([block] * len(parts)), pa.array(keys, pa.binary()),
                                       pa.array(n, pa.binary())], names=["part", "block", what, "n"])


def _word_features(blocks: DataFrame, groups: int) -> DataFrame:
    """(part, block, words, n): a block's distinct words of each group with training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory()
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs = _opened(data.as_py())
                train, texts = _train_flags(docs), _texts(docs)
                pieces, distinct = _words(texts)
                n = np.zeros(len(distinct) + 1, np.int64)
                for doc, word in pieces:
                    n += np.bincount(word, weights=train[doc], minlength=len(n)).astype(np.int64)
                n[-1] = train.sum()  # the end token, an empty word
                words = distinct.to_pylist() + [b""]
                parts = [(g, zstandard.ZstdCompressor(level=1).compress(b" ".join([words[i] for i in at]) + b"|"), _packed(n[at]))
                         for g, at in _by_group(np.append(_word_group(distinct, groups), 0))]
                yield _feature_rows(block, parts, "words")
        give_back()

    return blocks.select("block", "docs").mapInArrow(run, "part int, block long, words binary, n binary")


def _run_features(blocks: DataFrame, groups: int, salts: int) -> DataFrame:
    """(part, block, runs, n): a block's distinct runs of each group with training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory()
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs = _opened(data.as_py())
                runs, n = _runs(_texts(docs), _train_flags(docs))
                parts = [(g, _rising(runs[at]), _packed(n[at])) for g, at in _by_group(_run_group(runs, groups, salts))]
                yield _feature_rows(block, parts, "runs")
        give_back()

    return blocks.select("block", "docs").mapInArrow(run, "part int, block long, runs binary, n binary")


# --- Merging over all blocks -------------------------------------------------------

def _merged_words(rows: pa.Table) -> pa.Table:
    """Counts of each block's words over all blocks; the group's tokens and known words, once."""
    lists = [zstandard.ZstdDecompressor().decompress(w.as_py())[:-1].split(b" ") for w in rows.column("words")]
    sizes = [len(x) for x in lists]
    coded = pa.array([w for x in lists for w in x], pa.large_binary()).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(n, index, np.concatenate([_unpacked(x.as_py()) for x in rows.column("n")]))
    cuts = np.cumsum([0, *sizes])
    first = np.arange(len(sizes)) == 0
    return pa.Table.from_arrays([
        rows.column("block").combine_chunks(), rows.column("part").combine_chunks(),
        pa.array([_packed(n[index[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        pa.array(np.where(first, n.sum(), 0)), pa.array(np.where(first, (n > 0).sum(), 0))],
        names=["block", "part", "n", "tokens", "known"])


class Trees:
    """The context trees of distinct runs in rising order with counts, depths TOP + 1
    to DEPTH.  Entries of depth d are the distinct last d + 1 bytes of the runs; they
    are sorted, so a node of the byte's binary tree is a stretch of them."""

    def __init__(self, runs: np.ndarray, n: np.ndarray):
        self.key, self.n, self.up = {DEPTH: runs}, {DEPTH: n}, {}
        for d in range(DEPTH - 1, TOP - 1, -1):
            below = self.key[d + 1] & ((1 << 8 * (d + 1)) - 1)
            order = below.argsort()
            new = np.diff(below[order], prepend=-1) != 0
            place = np.empty(len(order), np.int64)
            place[order] = np.cumsum(new) - 1
            self.key[d], self.up[d + 1] = below[order][new], place
            self.n[d] = np.bincount(place, weights=self.n[d + 1], minlength=int(new.sum())).astype(np.int64)

    def level(self, k: int) -> dict[int, tuple]:
        """For decision k and each depth: (first entry and node of every
        entry, ones, total, log Pw, weight)."""
        out: dict[int, tuple] = {}
        for d in range(DEPTH, TOP, -1):
            new = np.diff(self.key[d] >> (8 - k), prepend=-1) != 0
            first = np.flatnonzero(new)
            node = np.cumsum(new) - 1
            total = np.add.reduceat(self.n[d], first)
            ones = np.add.reduceat(self.n[d] * (self.key[d] >> (7 - k) & 1), first)
            pe = log_kt(total - ones, ones)
            if d == DEPTH:
                pw, weight = pe, np.ones(len(pe))
            else:
                below = out[d + 1]
                child = np.bincount(node[self.up[d + 1][below[0]]], weights=below[4], minlength=len(pe))
                pw, weight = np.logaddexp(pe, child) - _LN2, _sigmoid(pe - child)
            out[d] = (first, node, ones, total, pw, weight)
        return out

    def nodes(self, k: int) -> np.ndarray:
        """Node of depth TOP of each entry there: context bytes, then a leading one and k bits."""
        key = self.key[TOP]
        return (key >> 8 << 8) | (1 << k) | ((key & 255) >> (8 - k))

    def top_rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the nodes of depth TOP: counts, and the log Pw of their children summed."""
        found = []
        for k in range(8):
            first, _, ones, total, pw, _ = self.level(k)[TOP + 1]
            at = self.nodes(k)[self.up[TOP + 1][first]]
            ids, place = np.unique(at, return_inverse=True)
            found.append((ids, *[np.bincount(place, weights=v, minlength=len(ids)) for v in (total, ones, pw)]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def log_probability(self, top: Top) -> np.ndarray:
        """log10 probability of each run's byte in its context."""
        out = np.zeros(len(self.key[DEPTH]))
        for k in range(8):
            levels = self.level(k)
            at, p = np.arange(len(out)), None
            for d in range(DEPTH, TOP, -1):
                _, node, ones, total, _, weight = levels[d]
                w, kt = weight[node[at]], ((ones + 0.5) / (total + 1))[node[at]]
                p = kt if p is None else w * kt + (1 - w) * p
                at = self.up[d][at]
            a, b = top.mixing(self.nodes(k))
            p = a[at] + b[at] * p
            out += np.log10(np.where(self.key[DEPTH] >> (7 - k) & 1, p, 1 - p))
        return out


class Top:
    """Estimates and weights of depth 0 to TOP, from the rows of all groups."""

    def __init__(self, node: np.ndarray, n: np.ndarray, ones: np.ndarray, child: np.ndarray):
        order = node.argsort()
        node, n, ones, child = node[order], n[order].astype(np.int64), ones[order].astype(np.int64), child[order]
        self.levels: dict[int, tuple] = {}
        for d in range(TOP, -1, -1):
            pe = log_kt(n - ones, ones)
            self.levels[d] = (node, (ones + 0.5) / (n + 1), _sigmoid(pe - child))
            if d:
                node, place = np.unique(node & ((1 << 8 * d) - 1), return_inverse=True)
                pw = np.logaddexp(pe, child) - _LN2
                n, ones = (np.bincount(place, weights=x, minlength=len(node)).astype(np.int64) for x in (n, ones))
                child = np.bincount(place, weights=pw, minlength=len(node))

    def mixing(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """a, b for nodes of depth TOP: a probability p from below becomes a + b * p."""
        a, b = np.zeros(len(node)), np.ones(len(node))
        for d in range(TOP, -1, -1):
            ids, kt, weight = self.levels[d]
            at = np.searchsorted(ids, node & ((1 << 8 * (d + 1)) - 1))
            w = weight[at]
            a, b = w * kt[at] + (1 - w) * a, (1 - w) * b
        return a, b


_MERGED = pa.schema([("part", pa.int32()), ("runs", pa.binary()), ("n", pa.binary()), ("blocks", pa.list_(pa.int64())),
                     ("places", pa.list_(pa.binary())), ("node", pa.list_(pa.int32())), ("total", pa.list_(pa.float64())),
                     ("ones", pa.list_(pa.float64())), ("child", pa.list_(pa.float64()))])


def _merged_runs(rows: pa.Table) -> pa.Table:
    """A group's runs over all blocks with their counts, where each block's runs
    are among them, and the group's part of depth TOP."""
    hold_memory()
    lists = [_risen(x.as_py()) for x in rows.column("runs")]
    runs, n = _tallied(np.concatenate(lists), np.concatenate([_unpacked(x.as_py()) for x in rows.column("n")]))
    places = [_rising(np.searchsorted(runs, x)) for x in lists]
    node, total, ones, child = Trees(runs, n).top_rows()
    return pa.Table.from_arrays([
        rows.column("part").slice(0, 1).combine_chunks(), pa.array([_rising(runs)], pa.binary()), pa.array([_packed(n)], pa.binary()),
        pa.array([rows.column("block").to_pylist()], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.binary())),
        *[pa.ListArray.from_arrays(pa.array([0, len(node)], pa.int32()), pa.array(x)) for x in (node.astype(np.int32), total, ones, child)]],
        schema=_MERGED)


def _values(merged: DataFrame, top) -> DataFrame:
    """(block, part, value, runs): log probabilities of each block's runs of a group,
    in units of VALUE_UNIT, and the runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory()
        for batch in batches:
            for part, runs, n, blocks, places in zip(*batch.columns):
                keys = _risen(runs.as_py())
                value = np.rint(Trees(keys, _unpacked(n.as_py())).log_probability(top.value) / VALUE_UNIT).astype(np.int64)
                for block, place in zip(blocks.values.to_pylist(), places.values):
                    at = _risen(place.as_py())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([block]), pa.array([part.as_py()], pa.int32()), pa.array([_packed(value[at])], pa.binary()),
                        pa.array([_rising(keys[at])], pa.binary())], names=["block", "part", "value", "runs"])
        give_back()

    return merged.select("part", "runs", "n", "blocks", "places").mapInArrow(run, "block long, part int, value binary, runs binary")


# --- Scoring -----------------------------------------------------------------------

_SCORES = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _scored(docs: pa.Table, words: dict[int, bytes], runs: list[tuple[bytes, bytes]], word_groups: int, unit: float) -> pa.Table:
    """Scores of a block's documents from each group's packed counts of words, and runs with log probabilities."""
    texts, n = _texts(docs), docs.num_rows
    pieces, distinct = _words(texts)
    count = np.zeros(len(distinct) + 1, np.int64)
    for g, at in _by_group(np.append(_word_group(distinct, word_groups), 0)):
        count[at] = _unpacked(words[g])
    logs = np.log10(count + 0.1)
    tokens, known = np.ones(n, np.int64), np.full(n, int(count[-1] > 0))
    base = np.full(n, logs[-1])
    for doc, word in pieces:
        tokens += np.bincount(doc, minlength=n)
        known += np.bincount(doc, weights=count[word] > 0, minlength=n).astype(np.int64)
        base += np.bincount(doc, weights=logs[word], minlength=n)
    keys = np.concatenate([_risen(k) for k, _ in runs])
    order = keys.argsort()
    keys, lp = keys[order], np.concatenate([_unpacked(v) for _, v in runs])[order] * VALUE_UNIT
    score = np.zeros(n)
    for code, owner in _run_pieces(texts):
        order = _together(code)
        code = code[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        mine = np.empty(len(code))
        mine[order] = np.repeat(lp[np.searchsorted(keys, code[first])], np.diff(np.append(first, len(code))))
        score += np.bincount(owner, weights=mine, minlength=n)
    return pa.Table.from_arrays([
        docs.column("id").combine_chunks(), docs.column("train").combine_chunks(),
        pc.binary_length(texts).cast(pa.int64()), pa.array(tokens), pa.array(known), pa.array(base - tokens * unit), pa.array(score)],
        schema=_SCORES)


def score(docs: DataFrame, train: Column, text_col: str = "text", id_col: str = "doc_id",
          block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES, groups_per_salt: int = GROUPS_PER_SALT) -> DataFrame:
    """Learn from the rows where ``train`` holds and score all rows: doc_id,
    train, n_bytes, n_tokens, n_known, train_tokens, base_score, score (log10
    probability of the text) and bits_per_byte (code length)."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                    F.coalesce(train, F.lit(False)).alias("train"))
    scratch = Scratch(spark)
    blocks = scratch.stored(_blocks(d, block_bytes), "blocks")
    size = blocks.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    # Groups of a few MB of text each; where they are many, subtrees are cut so that none outgrows its share.
    run_groups = max(n_shuffle(spark), -(-size // group_bytes))
    word_groups = max(n_shuffle(spark), -(-size // (8 * group_bytes)))
    salts = min(256, max(1, run_groups // groups_per_salt))
    words = scratch.stored(_word_features(blocks, word_groups).groupBy("part").applyInArrow(
        _merged_words, "block long, part int, n binary, tokens long, known long"), "words")
    sums = words.agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).first()
    total, vocabulary = sums["n"] or 0, sums["v"] or 0
    merged = scratch.stored(_run_features(blocks, run_groups, salts).groupBy("part").applyInArrow(
        _merged_runs, "part int, runs binary, n binary, blocks array<long>, places array<binary>, node array<int>, "
        "total array<double>, ones array<double>, child array<double>"), "runs")
    rows = (merged.select(F.explode(F.arrays_zip("node", "total", "ones", "child")).alias("r")).select("r.*").groupBy("node")
            .agg(F.sum("total").alias("total"), F.sum("ones").alias("ones"), F.sum("child").alias("child")).toArrow())
    column = lambda c, kind: rows.column(c).to_numpy().astype(kind)  # noqa: E731  at most 255 nodes a pair of bytes
    top = spark.sparkContext.broadcast(Top(column("node", np.int64), column("total", float), column("ones", float), column("child", float)))
    back = words.select("block", "part", F.col("n").alias("value"), F.lit(None).cast("binary").alias("runs")).unionByName(
        _values(merged, top))
    unit = math.log10(total + 0.1 * (vocabulary + 1))

    def scored(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows:
            return _SCORES.empty_table()
        hold_memory()
        words, runs = {}, []
        for part, value, keys in zip(b.column("part").to_pylist(), b.column("value"), b.column("runs")):
            if keys.is_valid:
                runs.append((keys.as_py(), value.as_py()))
            else:
                words[part] = value.as_py()
        out = _scored(_opened(a.column("docs")[0].as_py()), words, runs, word_groups, unit)
        del words, runs
        give_back()
        return out

    out = blocks.select("block", "docs").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        scored, "doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double")
    out = stored(out, "scores")
    scratch.drop()
    return out.withColumn("train_tokens", F.lit(total).cast("long")).withColumn(
        "bits_per_byte", -F.col("score") / F.lit(math.log10(2)) / F.greatest("n_bytes", F.lit(1)))


def op4_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, id_mod("doc_id", 10) != 0)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                      "score", "n_bytes", "bits_per_byte")
