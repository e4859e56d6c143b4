"""Token counts with overlap resynchronisation.

A text of up to ``chunk_bytes`` is encoded as it stands.  A longer one is
encoded in overlapping chunks with offsets; two neighbours are spliced at the
first position in their overlap that is a token edge in both encodings and a
stable cut of the tokenizer (``bpe.STABLE``: whatever the context, a token ends
there).  Where the overlap has no such position it is doubled and the chunk
encoded again, up to the whole rest of the text, so the count always equals
that of the whole text.  Memory is in proportion to a chunk where stable cuts are
(white space, CJK punctuation); text without any is encoded as a whole.

One pass without a shuffle.  Null text counts as empty: 0 bytes, 0 tokens.
Repeated rows are counted one by one; other columns are carried along, and a
column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.bpe import STABLE, Encoder, default_path, encoder
from tripcast.llm.common import give_back, slices, table, utf8_parts

CHUNK_BYTES, OVERLAP_BYTES = 32_768, 256
OUTPUTS = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("n_chunks", T.LongType())]


def _char_edge(raw: bytes, at: int) -> int:
    """``at`` or the next position that starts a character."""
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(raw))


def _encoded(enc: Encoder, raw: bytes, start: int, end: int) -> np.ndarray:
    """Positions in ``raw`` where the tokens of raw[start:end] end."""
    ids = enc.encode(raw[start:end].decode())
    return start + np.cumsum(enc.length_of[ids])


def _splice(raw: bytes, left: np.ndarray, right: np.ndarray, after: int, before: int) -> int | None:
    """First stable position in (after, before) that both encodings agree on."""
    for p in np.intersect1d(left[(left > after) & (left < before)], right[(right > after) & (right < before)],
                            assume_unique=False):
        if STABLE.match(raw, p):
            return int(p)
    return None


def count_tokens(enc: Encoder, raw: bytes, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> tuple[int, int]:
    """Tokens of the UTF-8 text ``raw`` and the number of chunk encodings made."""
    if len(raw) <= chunk:
        return len(enc.encode(raw.decode())), 1
    total, made = 0, 1
    start, begin = 0, 0  # of the current chunk; where counting goes on
    end = _char_edge(raw, start + chunk + overlap)
    edges = _encoded(enc, raw, start, end)
    while end < len(raw):
        then = _char_edge(raw, start + chunk)
        following_end = _char_edge(raw, then + chunk + overlap)
        following = _encoded(enc, raw, then, following_end)
        made += 1
        width = overlap
        while (p := _splice(raw, edges, following, then, min(end, following_end))) is None and end < len(raw):
            width *= 2
            end = _char_edge(raw, min(len(raw), start + chunk + width))
            edges = _encoded(enc, raw, start, end)
            if end > following_end:
                following_end = end
                following = _encoded(enc, raw, then, following_end)
                made += 1
            made += 1
        if p is None:  # the current chunk has come to reach the end of the text
            break
        total += int(np.searchsorted(edges, p, side="right") - np.searchsorted(edges, begin, side="right"))
        start, end, edges, begin = then, following_end, following, p
    return total + len(edges) - int(np.searchsorted(edges, begin, side="right")), made


def count(docs: DataFrame, text_col: str = "text", path: str | None = None,
          chunk_bytes: int = CHUNK_BYTES, overlap_bytes: int = OVERLAP_BYTES) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and n_chunks (encodings made)."""
    path = path or default_path()
    names = [n for n, _ in OUTPUTS]
    keep = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in OUTPUTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, "__text"):
                raw, off = utf8_parts(part.column(part.schema.get_field_index("__text")))
                data = raw.tobytes()
                got = [count_tokens(enc, data[a:b], chunk_bytes, overlap_bytes) for a, b in zip(off[:-1], off[1:])]
                new = [pa.array(np.diff(off)), pa.array([t for t, _ in got], pa.int64()),
                       pa.array([c for _, c in got], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + new, names=keep + names)
        give_back()

    text = F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    return docs.select(*keep, text).mapInArrow(run, schema)


def op2_token_counts(spark: SparkSession, sf_dir: str, limit: int = 512) -> DataFrame:
    out = count(table(spark, sf_dir, "documents").select("doc_id", "text").withColumnRenamed("text", "t"), "t")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks")
