"""BPE encoding and decoding with content-defined chunk reuse.

Each text is cut where a rolling hash of the last 16 bytes has its top bits
zero, so equal passages are cut alike wherever they stand.  A chunk is encoded
once and its ids are reused by every text that holds it.  At each chunk join
the ids may differ from those of the whole text; the stretch between the
nearest stable cuts (``bpe.STABLE``) on either side is encoded again and the
result spliced in where token edges agree exactly, over as many chunks as that
takes.  The ids therefore equal those of the whole text.

Texts meet by content: rows go to tasks by ranges of their smallest chunk hash, so
near copies land in the same task, where they share a chunk
store of bounded size (least recently used goes first).  The ranges are the quantiles of a
sample of at most SAMPLE_ROWS rows, which only balances tasks; a hash that fills several
ranges is dealt over all of them by a hash of its row, so a group of any
size spreads over as many tasks as its rows need.  Hashes are worked out once, on the way into the
shuffle.  A chunk evicted or
met in another task is simply encoded again: results never depend on the store.

Null text counts as empty (no ids).  Repeated rows are encoded one by one from
the same chunks; other columns are carried along, and a column named like an
output is replaced.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.bpe import STABLE, Encoder, default_path, encoder
from tripcast.llm.common import SLICE_BYTES, give_back, mix, n_shuffle, slices, table, utf8_parts

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 256, 16_384, 11  # about 2 KB a chunk
STORE_BYTES = 48 << 20
SAMPLE_ROWS = 20_000
# The rolling hash adds a pseudo-random number per byte, fixed by this rule.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def _rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes up to each position."""
    h = GEAR[raw]
    for step in (1, 2, 4, 8):
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint32(step)
        h = wider
    return h


def _cut_points(raw: np.ndarray) -> np.ndarray:
    """Where the rolling hash asks for a cut: behind the matching byte, moved to
    the next character start."""
    at = np.flatnonzero(_rolling(raw) >> np.uint32(32 - CUT_BITS) == 0) + 1
    for _ in range(3):
        inside = at < len(raw)
        inside[inside] = raw[at[inside]] & 0xC0 == 0x80
        at = at + inside
    return at


def _bounds(raw: bytes, asked: np.ndarray) -> list[int]:
    """Chunk limits of one text: the asked cuts at least MIN_CHUNK apart, and
    forced ones where a chunk would pass MAX_CHUNK."""
    out, last, n = [0], 0, len(raw)
    for c in [*asked.tolist(), n]:
        while c - last > MAX_CHUNK:
            last += MAX_CHUNK
            while last < n and raw[last] & 0xC0 == 0x80:
                last += 1
            out.append(last)
        if c == n or c - last >= MIN_CHUNK:
            if c > last:
                out.append(c)
            last = c
    return out


def chunks(text: str) -> list[bytes]:
    """The content-defined chunks of one text."""
    raw = text.encode()
    b = _bounds(raw, _own_cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
    return [raw[i:j] for i, j in zip(b[:-1], b[1:])]


def _own_cuts(raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Cuts of each text of a batch, relative to its start.  A window that
    reaches back into the text before is no cut."""
    at = _cut_points(raw) if len(raw) else np.zeros(0, np.int64)
    lo, hi = np.searchsorted(at, off[:-1] + 16), np.searchsorted(at, off[1:])
    return [at[a:b] - o for a, b, o in zip(lo, hi, off[:-1])]


class Store:
    """Chunk -> (ids, where they end in bytes), bounded, least recently used out."""

    def __init__(self, enc: Encoder, most: int = STORE_BYTES):
        self.enc, self.most, self.held = enc, most, 0
        self.kept: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.encoded = self.reused = 0

    def get(self, chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
        got = self.kept.get(chunk)
        if got is not None:
            self.kept.move_to_end(chunk)
            self.reused += 1
            return got
        ids = np.array(self.enc.encode(chunk.decode()), self.enc.id_type)
        got = (ids, np.cumsum(self.enc.length_of[ids], dtype=np.int32))
        self.encoded += 1
        self.kept[chunk] = got
        self.held += len(chunk) + got[0].nbytes + got[1].nbytes + 400
        while self.held > self.most and len(self.kept) > 1:
            old, (a, b) = self.kept.popitem(last=False)
            self.held -= len(old) + a.nbytes + b.nbytes + 400
        return got


def _stable_edges(raw: bytes, lo: int, hi: int, backwards: bool) -> Iterator[int]:
    """Stable cuts strictly inside (lo, hi), nearest first from one end."""
    if not backwards:
        yield from (m.start() for m in STABLE.finditer(raw, lo + 1, hi))
        return
    end, width = hi, 64
    while end > lo + 1:
        begin = max(lo + 1, end - width)
        yield from reversed([m.start() for m in STABLE.finditer(raw, begin, end)])
        end, width = begin, width * 2


def encode(store: Store, raw: bytes, bounds: list[int]) -> np.ndarray:
    """Ids of the whole text from its chunks, joins repaired."""
    enc = store.enc
    if len(bounds) <= 2:
        return store.get(raw)[0] if raw else np.zeros(0, enc.id_type)
    parts = [store.get(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    def edge(k: int, backwards: bool) -> tuple[int, bool]:
        """In chunk k the stable cut nearest to the join where its tokens have
        an edge too; else the far end of the chunk."""
        a, b = bounds[k], bounds[k + 1]
        ends = parts[k][1]
        for p in _stable_edges(raw, a, b, backwards):
            i = int(np.searchsorted(ends, p - a))
            if i < len(ends) and ends[i] == p - a:
                return p, True
        return (a if backwards else b), False

    regions: list[list[int]] = []
    for k in range(1, len(bounds) - 1):
        left, right = edge(k - 1, True)[0], edge(k, False)[0]
        if regions and left <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], right)
        else:
            regions.append([left, right])
    out, at = [], 0  # kept tokens run from `at` to the next region, inside one chunk
    for left, right in [*regions, [len(raw), len(raw)]]:
        if left > at:
            k = int(np.searchsorted(bounds, at, side="right")) - 1
            ids, ends = parts[k]
            i = int(np.searchsorted(ends, at - bounds[k], side="right")) if at > bounds[k] else 0
            j = int(np.searchsorted(ends, left - bounds[k], side="right"))
            out.append(ids[i:j])
        if right > left:
            out.append(np.array(enc.encode(raw[left:right].decode()), enc.id_type))
        at = right
    return np.concatenate(out)


def _routing_keys(arr: pa.Array) -> np.ndarray:
    """Smallest chunk hash of each text: near copies share it most of the time."""
    raw, off = utf8_parts(arr)
    out = np.zeros(len(off) - 1, np.int64)
    group = 0
    while group < len(out):
        end = max(group + 1, int(np.searchsorted(off, off[group] + SLICE_BYTES, side="right")) - 1)
        end = min(end, len(out))
        part, o = raw[off[group]:off[end]], off[group:end + 1] - off[group]
        data = part.tobytes()
        for i, cuts in enumerate(_own_cuts(part, o)):
            doc = data[o[i]:o[i + 1]]
            b = _bounds(doc, cuts)
            out[group + i] = min((int.from_bytes(hashlib.blake2b(doc[x:y], digest_size=8).digest(), "big", signed=True)
                                  for x, y in zip(b[:-1], b[1:])), default=0)
        group = end
    return out


def _limits(docs: DataFrame, parts: int) -> np.ndarray:
    """Upper limits of all ranges but the last, from a sample."""
    n = docs.count()
    if not n:
        return np.zeros(0, np.int64)
    some = docs.sample(min(1.0, SAMPLE_ROWS / n), seed=1).limit(2 * SAMPLE_ROWS).select("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_routing_keys(batch.column(0)))], names=["key"])

    keys = np.sort(some.mapInArrow(run, "key long").toArrow().column("key").to_numpy())
    return keys[np.arange(1, parts) * len(keys) // parts] if len(keys) else np.zeros(0, np.int64)


def _range_of(limits: np.ndarray):
    """Range of a text; a key that is the limit of several ranges takes one by the row's hash."""
    @F.pandas_udf(T.IntegerType())
    def place(text: pd.Series, row: pd.Series) -> pd.Series:
        key = _routing_keys(pa.array(text, pa.string()))
        low, high = np.searchsorted(limits, key, side="left"), np.searchsorted(limits, key, side="right")
        return pd.Series((low + row.to_numpy().astype(np.uint64) % (high - low + 1).astype(np.uint64)).astype(np.int32))
    return place


KINDS = {"n_tokens": (T.LongType(), pa.int64()), "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
         "decoded": (T.StringType(), pa.string()), "ids_sha256": (T.StringType(), pa.string()),
         "decoded_sha256": (T.StringType(), pa.string())}


def _values(enc: Encoder, ids: list[int], names: tuple[str, ...]) -> dict:
    out = {"n_tokens": len(ids), "ids": ids}
    if "ids_sha256" in names:
        out["ids_sha256"] = hashlib.sha256(",".join([enc.decimal_of[x] for x in ids]).encode()).hexdigest()
    if "decoded" in names or "decoded_sha256" in names:
        out["decoded"] = enc.decode(ids)
        out["decoded_sha256"] = hashlib.sha256(out["decoded"].encode()).hexdigest()
    return out


def coded(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None,
          outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """``docs`` without the text column, with ``outputs``, any of n_tokens, ids
    (array of int), decoded (the text the ids decode to), ids_sha256 (of the
    decimal ids joined by commas) and decoded_sha256 (of its UTF-8)."""
    path = path or default_path()
    names = list(outputs)
    keep = [c for c in docs.columns if c not in names and c != text_col]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, KINDS[n][0]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        store = Store(enc)
        for batch in batches:
            for part in slices(batch, "__text"):
                raw, off = utf8_parts(part.column(part.schema.get_field_index("__text")))
                data, rows, last, result = raw.tobytes(), [], None, None
                for i, cuts in enumerate(_own_cuts(raw, off)):
                    doc = data[off[i]:off[i + 1]]
                    if doc != last:
                        result, last = _values(enc, encode(store, doc, _bounds(doc, cuts)).tolist(), outputs), doc
                    rows.append(result)
                new = [pa.array([r[n] for r in rows], KINDS[n][1]) for n in names]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + new, names=keep + names)
        give_back()

    d = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    parts = n_shuffle(docs.sparkSession)
    place = _range_of(_limits(d, parts))("__text", F.xxhash64("__text", id_col))
    return d.withColumn("__part", place).repartition(parts, "__part").drop("__part").mapInArrow(run, schema)


def op8_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return coded(docs, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
