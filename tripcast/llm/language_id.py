"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over labelled text.  A document
is parsed greedily against each automaton: the longest match from the current
position is one phrase, parsing goes on behind it.  The language that needs
the fewest phrases per byte wins.

Model: :func:`fit` takes a bounded sample of labelled rows, ``rows_per_lang``
rows per language chosen by a hash of id and text, at most ``row_chars`` code
points of each from a hashed position, ``total_bytes`` in all divided evenly
among the languages.  Rows are first thinned by the same hash to about 64
times that many per language, so what is ranked does not grow with the corpus,
and no more than the bytes that the model keeps (and one row a language) reach
the driver.  Only text and label are used.

Prediction: one pass without a shuffle.  Text is lower-cased, ASCII
non-letters become single spaces, and blocks of ``BLOCK`` bytes are parsed in
lock step as numpy lanes through dense transition tables, so a very long
document is just many lanes.  The parse restarts at a block edge for every
language alike.

Edge cases: a text that is null or has no letter gives ``und`` with score 0.
Equal phrase counts go to the alphabetically first language.  With nothing to
learn from, every text is ``und``.  Repeated rows are predicted one by one;
other columns are carried along, and a column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.common import give_back, held, id_mod, slices, table, utf8_parts
from tripcast.operators.broadcast import checked_broadcast

BLOCK = 1024
OUTPUTS = [("lang_pred", T.StringType(), pa.string()), ("score", T.DoubleType(), pa.float64()),
           ("phrases", T.LongType(), pa.int64()), ("parsed_bytes", T.LongType(), pa.int64())]


@dataclass(frozen=True)
class Model:
    """Languages in alphabetical order and the normalised sample of each."""
    langs: tuple[str, ...]
    samples: tuple[bytes, ...]


def _folded(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ASCII non-letters to spaces, runs of spaces (and a leading one) to one."""
    out = raw.copy()
    other = (raw < 128) & ~((raw >= 97) & (raw <= 122))
    out[other] = 32
    drop = np.zeros(len(out), bool)
    if len(out):
        drop[1:] = other[1:] & other[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        drop[heads] = other[heads]
    kept = np.concatenate([[0], np.cumsum(~drop)])
    return out[~drop], kept[off]


def normalised(text: str) -> bytes:
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    return _folded(raw, np.array([0, len(raw)]))[0].tobytes()


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        rows_per_lang: int = 256, row_chars: int = 1000, total_bytes: int = 120_000) -> Model:
    """Learn from a bounded sample of the rows whose text and label are not null."""
    d = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    d = d.filter("text is not null and lang is not null and text rlike '\\\\p{L}'")
    d = d.withColumn("h", F.xxhash64("id", "text"))
    d = d.withColumn("piece", F.expr(
        f"substring(text, cast(1 + pmod(h, greatest(char_length(text) - {row_chars}, 0) + 1) as int), {row_chars})"))
    sizes = labelled.select(F.col(lang_col).alias("lang")).filter("lang is not null").groupBy("lang").agg(
        F.count(F.lit(1)).alias("size"))  # a row per language
    place = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    d = d.join(checked_broadcast(sizes), "lang").filter(place * F.col("size") < 64 * rows_per_lang)
    first = Window.partitionBy("lang").orderBy("h", "id", "piece")
    few = (d.select("lang", "h", "id", "piece").withColumn("k", F.row_number().over(first))
           .filter(F.col("k") <= rows_per_lang).withColumn("data", _normalised_pieces("piece")))
    each = total_bytes // max(1, sizes.count())
    before = Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = (few.withColumn("before", F.coalesce(F.sum(F.length("data") + 1).over(before), F.lit(0)))
            .filter((F.col("k") == 1) | (F.col("before") < each))
            .select("lang", "k", F.substring("data", 1, each).alias("data")).collect())
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["k"], bytes(r["data"])))
    langs = tuple(sorted(by))
    return Model(langs, tuple(b"\0".join(p for _, p in sorted(by[x]))[:each] for x in langs))


@F.pandas_udf(T.BinaryType())
def _normalised_pieces(pieces: pd.Series) -> pd.Series:
    return pieces.map(normalised)


def _suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of ``data``."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def _tables(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return held(("language", model), lambda: _built(model))


def _built(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense table over all automata, symbol of each byte, root of each language.

    An entry holds ``next state * symbols`` above two bits that count the
    phrases ended by the step: 0 inside a match, 1 where a match ends (or an
    unseen byte stands alone), 2 where a match ends at an unseen byte.
    """
    seen = sorted({b for s in model.samples for b in s} - {0})
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    width, parts, roots, base = len(seen) + 1, [], [], 0
    for data in model.samples:
        nxt = _suffix_automaton(data)
        root = np.full(width, base * width * 4, np.int64)
        known = np.zeros(width, bool)
        for c, t in nxt[0].items():
            if c:
                root[symbol[c]] = (base + t) * width * 4
                known[symbol[c]] = True
        dense = np.tile(root + np.where(known, 1, 2), (len(nxt), 1))
        dense[0] = root + np.where(known, 0, 1)
        for s, row in enumerate(nxt):
            for c, t in row.items():
                if c:
                    dense[s, symbol[c]] = (base + t) * width * 4
        parts.append(dense.astype(np.int32))
        roots.append(base * width)
        base += len(nxt)
    if base * width * 4 >= 2 ** 31:
        raise ValueError("total_bytes is too large for the transition table")
    return np.concatenate(parts).ravel(), symbol, np.array(roots, np.int32)


def phrase_counts(raw: np.ndarray, off: np.ndarray, model: Model) -> np.ndarray:
    """Phrases of each normalised text under each language: [language, text]."""
    dense, symbol, roots = _tables(model)
    sym = symbol[raw]
    size = np.diff(off)
    blocks = -(-size // BLOCK)
    doc = np.repeat(np.arange(len(size)), blocks)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start, lane = off[doc] + k * BLOCK, np.minimum(BLOCK, size[doc] - k * BLOCK)
    order = np.argsort(-lane, kind="stable")
    start, lane, doc = start[order], lane[order], doc[order]
    state = np.repeat(roots[:, None], len(lane), axis=1)
    count = np.zeros(state.shape, np.int32)
    alive = np.searchsorted(-lane, -np.arange(int(lane[0]) if len(lane) else 0), side="left")
    for t, w in enumerate(alive):
        entry = dense[state[:, :w] + sym[start[:w] + t]]
        count[:, :w] += entry & 3
        state[:, :w] = entry >> 2
    count += state != roots[:, None]
    out = np.zeros((len(roots), len(size)), np.int64)
    for i in range(len(roots)):
        out[i] = np.bincount(doc, weights=count[i], minlength=len(size)).astype(np.int64)
    return out


def _decide(texts: pa.Array, letters: np.ndarray, model: Model) -> list[pa.Array]:
    raw, off = _folded(*utf8_parts(pc.utf8_lower(pc.fill_null(texts, ""))))
    size, n = np.diff(off), len(texts)
    if not model.langs:
        return [pa.array(["und"] * n), pa.array(np.zeros(n)), pa.array(np.zeros(n, np.int64)), pa.array(size)]
    c = phrase_counts(raw, off, model)
    best = np.argmin(c, axis=0)
    low = c[best, np.arange(n)]
    if len(model.langs) > 1:
        second = np.sort(c, axis=0)[1]
        score = second / np.maximum(low + second, 1)
    else:
        score = np.ones(n)
    named = np.array(model.langs, object)[best]
    named[~letters] = "und"
    return [pa.array(named, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(low), pa.array(size)]


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1: how clearly the winner beats the
    runner-up, 0.5 for a tie), phrases and parsed_bytes."""
    names = [n for n, _, _ in OUTPUTS]
    keep = [c for c in docs.columns if c not in names]
    flagged = docs.select(*keep, F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)).alias("__letters"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t, _ in OUTPUTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                letters = part.column(part.schema.get_field_index("__letters")).to_numpy(zero_copy_only=False)
                new = _decide(part.column(part.schema.get_field_index(text_col)), letters.astype(bool), model)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + new, names=keep + names)
        give_back()

    return flagged.mapInArrow(run, schema)


def accepted(max_rate: float = 0.5):
    """Condition on predicted rows: a known language that fits the text, that
    is, whose phrases are longer than 1 / max_rate bytes on average."""
    return (F.col("lang_pred") != "und") & (F.col("phrases") <= F.lit(max_rate) * F.col("parsed_bytes") + 1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = id_mod("doc_id", 4) == 2
    model = fit(docs.filter(~held))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "phrases", "parsed_bytes")
