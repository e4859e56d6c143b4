"""Personal data, and the terms that disclose it by what the corpus says.

Base spans are e-mail addresses, IPv4 addresses, card numbers (16 to 19 digits
with a valid check digit) and international phone numbers (8 to 15 digits), each
kind found left to right without overlaps.  Every distinct value is a
protected entity c.  The words within ``window`` words of a mention are its context;
a word t co-occurs with c in a document if it is in the context of one of c's
mentions there.  With n documents in all,

    information content  IC(c) = log2(n / n(c))
    mutual information   PMI(c; t) = log2(n * n(c, t) / (n(c) * n(t)))

PMI reaches IC when every document with t names c: then t gives c away though c
itself is gone.  A word discloses c if PMI >= ``disclose`` * IC and it was seen
with c in at least ``support`` different contexts (copies of one text show one
context, and chance words of rare entities few).  In documents that mention c
its disclosing words are spans of kind ``term``: removed if PMI >= ``remove`` * IC, else
generalised to what sort of word it is.

All counts cover the whole corpus.  Entities are kept as digests.  Rows between the
passes are those of mentions, at most 2 * ``window`` + 1 for each; word counts are
summed inside tasks first, and only words that pass the support test are
shuffled.  An entity that a third of all documents mention is summed before
each shuffle, and spans come back to their documents by a size-checked broadcast or else
a join that adaptive execution splits.

Edge cases: null text is empty and has no span.  Every row counts as a
document; rows that repeat id and text get the same spans.  An entity in all documents
has no information and is never disclosed.  Only the named columns are used.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import slices, stored, table
from tripcast.llm.lexical import terms
from tripcast.operators.broadcast import checked_broadcast

KINDS = ("email", "ip", "card", "phone")
WINDOW, SUPPORT, DISCLOSE, REMOVE = 8, 2, 0.95, 0.99
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# The parts of the base patterns, each without backtracking over more than its own match.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at  # back to where the local part begins; characters before an earlier "@" are never looked at again
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _NUMBERS.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts = [(m.start(), m.end()) for m in _NUMBER.finditer(text, chain.start(), chain.end())]
        for k in range(0, len(parts) - 3, 4):
            four = [text[a:b].lstrip("0") or "0" for a, b in parts[k:k + 4]]
            if all(len(x) < 4 and int(x) <= 255 for x in four):
                yield parts[k][0], parts[k + 3][1]


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    return [(k, a, b) for k, find in enumerate((_emails, _ips, _cards, _phones)) for a, b in find(text)]


def entity(kind: int, value: str) -> int:
    """Digest of the entity that a span names, however it is written."""
    if kind == 0:
        value = value.lower()
    elif kind == 1:
        value = ".".join(x.lstrip("0") or "0" for x in value.split("."))
    else:
        value = _NOT_DIGIT.sub("", value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def _contexts(text: str, spans: list[tuple[int, int, int]], window: int) -> Iterator[tuple[int, str, int, int, bytes]]:
    """(entity, word, start, end, digest of the context) of every context word."""
    covered = sorted((a, b) for _, a, b in spans)
    words, i = [], 0
    for m in _WORD.finditer(text):
        while i < len(covered) and covered[i][1] <= m.start():
            i += 1
        if i == len(covered) or covered[i][0] >= m.end():
            words.append(m.span())
    starts = [a for a, _ in words]
    for kind, a, b in spans:
        before, behind = bisect.bisect_left(starts, a), bisect.bisect_left(starts, b)
        near = words[max(0, before - window):before] + words[behind:behind + window]
        said = [text[x:y].lower() for x, y in near]
        digest = hashlib.blake2b("\0".join(said).encode(), digest_size=8).digest()
        e = entity(kind, text[a:b])
        for word, (x, y) in zip(said, near):
            yield e, word, x, y, digest


_MENTIONS = "key long, entity long, word string, start int, end int, context binary, first int"


def _mentions(docs: DataFrame, window: int) -> DataFrame:
    """A row per context word; ``first`` is 1 for the first of its (document,
    entity, word).  A row without a word counts the document for the entity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    spans = base_spans(text)
                    if not spans:
                        continue
                    rows += [(key, e, None, None, None, None, 1) for e in {entity(k, text[a:b]) for k, a, b in spans}]
                    seen: set[tuple[int, str]] = set()
                    for e, word, x, y, digest in _contexts(text, spans, window):
                        rows.append((key, e, word, x, y, digest, int((e, word) not in seen)))
                        seen.add((e, word))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["key", "entity", "word", "start", "end", "context", "first"])

    return docs.select("key", "text").mapInArrow(run, _MENTIONS)


def _word_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word, n_t): documents that hold each wanted word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lowered = pa.array([t.lower() for t in part.column(0).to_pylist()], pa.string())
                doc, word, distinct = terms(lowered)
                once = np.unique(word * max(part.num_rows, 1) + doc) // max(part.num_rows, 1)
                n = np.bincount(once, minlength=len(distinct)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([distinct.cast(pa.binary()).cast(pa.string()), pa.array(n)], names=["word", "n"])

    found = docs.select("text").mapInArrow(run, "word string, n long")
    return found.join(checked_broadcast(wanted), "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n_t"))


def disclosing(docs: DataFrame, mentions: DataFrame, support: int = SUPPORT, disclose: float = DISCLOSE,
               remove: float = REMOVE) -> DataFrame:
    """(entity, word, n_c, n_ct, n_t, ic, pmi, removed): words that give an entity away."""
    n = float(docs.count())
    entities = mentions.filter("word is null").groupBy("entity").agg(F.sum("first").alias("n_c"))
    pairs = (mentions.filter("word is not null").groupBy("entity", "word", "context").agg(F.sum("first").alias("n"))
             .groupBy("entity", "word").agg(F.sum("n").alias("n_ct"), F.count(F.lit(1)).alias("contexts"))
             .filter(F.col("contexts") >= support))
    pairs = stored(pairs.join(entities, "entity"), "pairs")
    counts = _word_counts(docs, stored(pairs.select("word").distinct(), "wanted"))
    both = pairs.join(stored(counts, "counts"), "word")
    ic = F.log2(F.lit(n) / F.col("n_c"))
    pmi = F.log2(F.col("n_ct") * F.lit(n) / (F.col("n_c") * F.col("n_t")))
    return (both.withColumn("ic", ic).withColumn("pmi", pmi)
            .filter((F.col("ic") > 0) & (F.col("pmi") >= F.col("ic") * disclose))
            .withColumn("removed", F.col("pmi") >= F.col("ic") * remove))


def sort_of(word: str) -> str:
    """What a generalised word is replaced by."""
    if word.isdigit():
        return "[NUMBER]"
    return "[NAME]" if word[:1].isupper() else "[WORD]"


def replaced(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text without its spans (kind, start, end, removed): marks for base kinds
    and generalised words; of overlapping spans the first one's mark."""
    out, done = [], 0
    for kind, a, b, removed in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], "" if removed else sort_of(text[a:b]) if kind == "term" else f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


_OUTPUT = ("id long, n_email long, n_ip long, n_card long, n_phone long, n_term long, base_sha256 string, spans string, "
           "sanitised string")


def sanitise(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, support: int = SUPPORT,
             disclose: float = DISCLOSE, remove: float = REMOVE) -> DataFrame:
    """Of each row its id, spans by kind, digest of the base spans, all spans as
    kind:start:end, and the sanitised text."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("key", F.xxhash64("id", "text"))
    mentions = stored(_mentions(d, window), "mentions")
    found = stored(disclosing(d, mentions, support, disclose, remove), "disclosing")
    spots = (mentions.join(checked_broadcast(found.select("entity", "word", "removed")), ["entity", "word"])
             .groupBy("key", "start", "end").agg(F.max("removed").alias("removed")))
    extra = stored(spots.groupBy(F.col("key").alias("at")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed")))
                                                               .alias("more")), "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 6, pa.string(), pa.string(), pa.string())
        names = ["id", "n_email", "n_ip", "n_card", "n_phone", "n_term", "base_sha256", "spans", "sanitised"]
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for i, text, more in zip(*(c.to_pylist() for c in part.columns)):
                    base = base_spans(text)
                    n = [0] * len(KINDS)
                    for k, _, _ in base:
                        n[k] += 1
                    said = [f"{KINDS[k]}:{a}:{b}" for k, a, b in base]
                    every = said + [f"term:{s['start']}:{s['end']}" for s in more or ()]
                    spans = [(KINDS[k], a, b, False) for k, a, b in base]
                    spans += [("term", s["start"], s["end"], s["removed"]) for s in more or ()]
                    rows.append((i, *n, len(more or ()), hashlib.sha256(",".join(said).encode()).hexdigest(), ",".join(every),
                                 replaced(text, spans) if spans else text))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    out = d.join(checked_broadcast(extra), F.col("key") == F.col("at"), "left").select("id", "text", "more").mapInArrow(run, _OUTPUT)
    return out.withColumnRenamed("id", id_col)


def op11_information_sanitising(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sanitise(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term",
                      F.sha2("sanitised", 256).alias("sanitised_sha256"))
