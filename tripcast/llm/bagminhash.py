"""Near-duplicate classes by BagMinHash.

A text is the multiset of its five-word shingles (words: runs of letters and
digits of any script, lower-cased, each character a word in scripts written
without spaces; a text of one to four words is a single shingle).  Two
texts are linked when the weighted Jaccard similarity of the multisets, sum of
minima over sum of maxima, is at least ``threshold``; a class is a connected
component of links.

Signature: for each shingle a Poisson process runs over its weight axis, which
is split into the dyadic blocks [0,1), [1,2), [2,4), ...; a point has a time, a
component out of M and a place in its block, and counts when the place lies
below the weight.  A component keeps its earliest point.  Blocks wholly below
the weight need no test, the one that holds the weight is thinned by descending
to the point's place.  Points are drawn in order of time, so a shingle stops as
soon as its next point is later than every component of its text; a text of n
shingles costs about n + M log M points.  Two texts agree in a component with a
probability equal to their weighted Jaccard similarity.

Search: texts with equal word sequences form one class from the start and are
stood for by the smallest id.  Signatures are cut into BANDS bands of ROWS
components; texts that share a band meet in a bucket.  Each text is verified
against the likeliest bucket leader first.  What a bucket then still holds of
different classes is compared exhaustively: a bucket of a few texts as pairs, a
larger one in blocks of bounded size inside tasks, which return the links that
join classes and never the pairs; the members of its largest class are compared
with the others only, which are sent to them, so each is moved as often as the
others fill blocks.  Pairs whose
signatures agree far less than the threshold are set aside (``slack``: more
than five standard errors), all others are verified exactly on whole texts.
Pairs inside one class need no test.

A text or word sequence that very many share is dealt over salts or met by a
broadcast of at most a few rows a partition, never gathered in one task.

Edge cases: ids are whole numbers.  A text that is null or has no word is a class of its own; a null
id gets a null class.  Rows that repeat an id are one document.  With M = 160
components and 32 bands of 5, a pair at similarity 0.8 is missed by all bands
with probability 3e-6.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import Scratch, give_back, mix, n_shuffle, slices, stored, table, utf8_parts
from tripcast.llm.components import components
from tripcast.operators.broadcast import checked_broadcast

BANDS, ROWS, SHINGLE = 32, 5, 5
M = BANDS * ROWS
THRESHOLD, SLACK = 0.8, 0.18
FEW, BLOCK_ROWS, BLOCK_SHINGLES = 8, 2048, 1 << 19
SLICE = 1 << 19  # bytes of text worked on together; a byte takes some 50 meanwhile
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED27))
_POWERS: dict[int, np.ndarray] = {}
# Blocks of scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han).
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))


@functools.cache
def _kinds() -> np.ndarray:
    """Of each code point: 1 letter or digit, 2 one that is a word by itself, 0 any other."""
    out = np.fromiter((chr(c).isalnum() for c in range(0x110000)), np.uint8, 0x110000)
    for low, high in _UNSPACED:
        out[low:high + 1] *= 2
    return out


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; kept for up to a slice."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE + (SLICE >> 3)), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= SLICE + (SLICE >> 3):
            _POWERS[int(base)] = have
    return have[:n]


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of lower-cased texts, and the text it belongs to."""
    inside = ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57)) | ((raw >= 65) & (raw <= 90))
    lead = np.flatnonzero(raw >= 0xC0)
    size = 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0).astype(np.int64)
    code = raw[lead].astype(np.int64) & (0x7F >> size)
    for k in (1, 2, 3):
        more = size > k
        code[more] = code[more] << 6 | raw[lead[more] + k] & 0x3F
    kind = _kinds()[code] if len(code) else np.zeros(0, np.uint8)
    for k in range(4):
        more = (size > k) & (kind > 0)
        inside[lead[more] + k] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    tails = off[1:][off[:-1] < off[1:]] - 1
    begin[heads] = inside[heads]
    alone = lead[kind == 2]
    behind = alone + size[kind == 2]
    behind = behind[behind < len(raw)]
    begin[alone] = True
    begin[behind] |= inside[behind]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | begin[1:]
    end[tails] = inside[tails]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)), dtype=np.uint64)])
    h = (total[last] - total[first]) * _powers(_INVERSE, len(raw) + 1)[first]
    return mix(h + (last - first).astype(np.uint64)), np.searchsorted(off, first, side="right") - 1


def shingles(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes and their texts; two 64-bit keys of each word sequence."""
    h, doc = words(raw, off)
    n_docs = len(off) - 1
    n = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(n) - n
    place = (np.arange(len(h)) - first[doc]).astype(np.int64)
    keys = []
    for seed in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
        part = mix(h ^ np.uint64(seed)) * _powers(np.uint64(seed | 1), int(n.max(initial=0)) + 1)[place]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
        keys.append(mix(sums[first + n] - sums[first] + n.astype(np.uint64)))
    c = _powers(np.uint64(0xC2B2AE3D27D4EB4F), SHINGLE)
    whole = np.flatnonzero(n[doc] - place >= SHINGLE)
    sh = np.zeros(len(whole), np.uint64)
    for k in range(SHINGLE):
        sh += h[whole + k] * c[k]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    return (np.concatenate([mix(sh), keys[0][short] ^ np.uint64(0x94D049BB)]),
            np.concatenate([doc[whole], short]), keys[0], keys[1])


def multisets(sh: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with its weight."""
    tagged = mix(sh + doc.astype(np.uint64) * _BASE)
    _, first, weight = np.unique(tagged, return_index=True, return_counts=True)
    return doc[first], sh[first], weight


def _uniform(seed: np.ndarray, salt: int) -> np.ndarray:
    return (mix(seed + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def signatures(doc: np.ndarray, sh: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """Earliest point of each component, [text, M]; inf where there is none."""
    levels = 1 + np.ceil(np.log2(weight)).astype(np.int64)  # dyadic blocks that reach below the weight
    row = np.repeat(np.arange(len(sh)), levels)
    level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    owner, limit = doc[row], weight[row]
    seed = mix(sh[row] + level.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    best = np.full(n_docs * M, np.inf)
    latest = np.full(n_docs, np.inf)
    time = np.zeros(len(row))
    live, turn = np.arange(len(row)), 0
    while len(live):
        for _ in range(1 if turn < 4 else 16):
            s = mix(seed[live] + np.uint64(turn))
            time[live] -= np.log(1.0 - _uniform(s, 1)) / width[live]
            w = width[live]
            place = low[live] + np.minimum((_uniform(s, 2) * w).astype(np.int64), w - 1)
            hit = place < limit[live]
            component = (_uniform(s, 3) * M).astype(np.int64)
            np.minimum.at(best, (owner[live] * M + component)[hit], time[live][hit])
            turn += 1
        touched = np.unique(owner[live])
        latest[touched] = best.reshape(n_docs, M)[touched].max(axis=1)
        live = live[time[live] < latest[owner[live]]]
    return best.reshape(n_docs, M)


def _signed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """id, word-sequence keys, shingle count, 8-bit signature and band hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "k1", "k2", "n", "sig", "bands"]
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                raw, off = utf8_parts(pc.utf8_lower(pc.fill_null(part.column(1), "")))
                count = len(off) - 1
                sh, doc, k1, k2 = shingles(raw, off)
                n = np.bincount(doc, minlength=count)
                owner, value, weight = multisets(sh, doc)
                best = mix(signatures(owner, value, weight, count).view(np.uint64))
                sig = (best & np.uint64(255)).astype(np.uint8)
                c = _powers(np.uint64(0xE7037ED1A0B428DB), ROWS)
                bands = mix((best.reshape(count, BANDS, ROWS) * c).sum(axis=2, dtype=np.uint64)
                            + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(n, pa.int64()),
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(M), count, [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * BANDS, pa.int32()),
                                             pa.array(bands.ravel()))], names=names)
        give_back()

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "id long, k1 long, k2 long, n long, sig binary, bands array<long>")


def _likeness(pairs: DataFrame) -> DataFrame:
    """Pairs with the share of agreeing signature bytes, corrected for chance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(utf8_parts(batch.column(i))[0], np.uint8).reshape(-1, M) for i in (2, 3))
            same = (a == b).mean(axis=1) if len(a) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((same - 1 / 256) / (1 - 1 / 256))],
                                             names=["a", "b", "est"])
    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, est double")


def _paired(pairs: DataFrame, side: DataFrame, value: str, names: tuple[str, str]) -> DataFrame:
    """(a, b) with the ``value`` of both.  The partners of one ``a`` are dealt over
    salts, and only ``a`` itself is sent once per salt that it has partners in."""
    salted = pairs.select("a", "b").withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(n_shuffle(pairs.sparkSession))).cast("int"))
    first = salted.select("a", "salt").distinct().join(side.select(F.col("id").alias("a"), F.col(value).alias(names[0])), "a")
    second = salted.join(side.select(F.col("id").alias("b"), F.col(value).alias(names[1])), "b")
    return second.join(first, ["a", "salt"]).select("a", "b", *names)


def _estimated(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    return _likeness(_paired(pairs, sigs, "sig", ("sa", "sb"))).filter(F.col("est") >= least)


def similarity(batch_a: pa.Array, batch_b: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingles of texts, row by row."""
    sides = []
    for arr in (batch_a, batch_b):
        raw, off = utf8_parts(pc.utf8_lower(pc.fill_null(arr, "")))
        sh, doc, _, _ = shingles(raw, off)
        tagged, first, weight = np.unique(mix(sh + doc.astype(np.uint64) * _BASE), return_index=True, return_counts=True)
        sides.append((tagged, doc[first], weight, np.bincount(doc, minlength=len(off) - 1)))
    (ta, da, wa, na), (tb, _, wb, nb) = sides
    _, ia, ib = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
    common = np.bincount(da[ia], weights=np.minimum(wa[ia], wb[ib]), minlength=len(na))
    return common / np.maximum(na + nb - common, 1)


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ta", SLICE):
                for piece in slices(part, "tb", SLICE):
                    sim = similarity(piece.column(2), piece.column(3))
                    good = np.flatnonzero(sim >= threshold - 1e-12)
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(good)), piece.column(1).take(pa.array(good)),
                                                      pa.array(sim[good])], names=["a", "b", "sim"])
        give_back()

    return _paired(pairs, texts, "text", ("ta", "tb")).mapInArrow(run, "a long, b long, sim double")


def _block_links(group: pa.Table, threshold: float, least: float) -> pa.Table:
    """Links that join classes, among the pairs of one bucket between two blocks
    (or within one) that no earlier band brings together."""
    group = group.sort_by([("block", "ascending"), ("id", "ascending")]).combine_chunks()
    n = group.num_rows
    block, ids, cls = (group.column(c).to_numpy() for c in ("block", "id", "c"))
    here, i, j = (group.column(c)[0].as_py() for c in ("bucket", "i", "j"))
    sig = np.frombuffer(utf8_parts(group.column("sig"))[0], np.uint8).reshape(n, M)
    bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
    band = int(np.flatnonzero(bands[0] == here)[0])
    parts, done = [], 0
    for batch in group.select(["text"]).to_batches():
        for part in slices(batch, "text", SLICE):
            sh, doc, _, _ = shingles(*utf8_parts(pc.utf8_lower(pc.fill_null(part.column(0), ""))))
            parts.append((sh, doc + done))
            done += part.num_rows
    sh, doc = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((sh, doc))
    sh, doc = sh[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])])) if len(sh) else np.zeros(0, int)
    weight = np.diff(np.append(first, len(sh)))
    sh, doc = sh[first], doc[first]
    start = np.searchsorted(doc, np.arange(n + 1))
    total = np.bincount(doc, weights=weight, minlength=n)
    up: dict[int, int] = {}

    def root(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    at, share = np.array([root(c) for c in cls]), least * 255 / 256 + 1 / 256
    out = []
    for x in np.flatnonzero(block == i):
        y = np.flatnonzero((block == j) & (at != at[x]))
        y = y[y > x] if i == j else y
        y = y[(sig[y] == sig[x]).mean(axis=1) >= share]
        y = y[(bands[y, :band] != bands[x, :band]).all(axis=1)]
        if not len(y):
            continue
        span = start[y + 1] - start[y]
        entry = np.repeat(start[y], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        mine, w = sh[start[x]:start[x + 1]], weight[start[x]:start[x + 1]]
        k = np.minimum(np.searchsorted(mine, sh[entry]), len(mine) - 1)
        common = np.bincount(np.repeat(np.arange(len(y)), span), minlength=len(y),
                             weights=np.where(mine[k] == sh[entry], np.minimum(w[k], weight[entry]), 0))
        sim = common / (total[x] + total[y] - common)
        for q in np.flatnonzero(sim >= threshold - 1e-12):
            a, b = root(int(cls[x])), root(int(cls[y[q]]))
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((min(int(ids[x]), int(ids[y[q]])), max(int(ids[x]), int(ids[y[q]])), float(sim[q])))
        if out:
            at = np.array([root(c) for c in cls])
    return pa.Table.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                 pa.array([r[2] for r in out], pa.float64())], names=["a", "b", "sim"])


def _exhaustive(now: DataFrame, sigs: DataFrame, texts: DataFrame, threshold: float, least: float) -> DataFrame:
    """Links between texts of one bucket (bucket, id, c, n) in different classes."""
    sizes = now.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    few, many = sizes.filter(F.col("size") <= FEW), sizes.filter(F.col("size") > FEW)
    left = now.join(few.select("bucket"), "bucket", "left_semi").select("bucket", F.col("id").alias("a"), F.col("c").alias("ca"))
    right = left.toDF("bucket", "b", "cb")
    pairs = left.join(right, "bucket").filter("a < b and ca <> cb").select("a", "b").distinct()
    small = _verified(_estimated(pairs, sigs, least), texts, threshold)
    # The largest class of each bucket and the rest, in blocks: rest 0 .. r - 1, class r .. r + m - 1.
    held = now.join(many.select("bucket"), "bucket", "left_semi").groupBy("bucket", "c").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    main = F.max(F.struct("size", (-F.col("c")).alias("c"), "shingles"))
    part = lambda size, n: F.greatest(F.ceil(size / BLOCK_ROWS), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    cut = held.groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("shingles").alias("n"), main.alias("l")).select(
        "bucket", (-F.col("l.c")).alias("main"), part(F.col("size") - F.col("l.size"), F.col("n") - F.col("l.shingles")).alias("r"),
        part(F.col("l.size"), F.col("l.shingles")).alias("m"))
    rows = now.select("bucket", "id", "c").join(cut, "bucket")
    own = F.xxhash64("id")
    inside = F.col("c") == F.col("main")
    rows = rows.withColumn("block", F.when(inside, F.col("r") + F.pmod(own, F.col("m"))).otherwise(F.pmod(own, F.col("r"))).cast("int"))
    # A row of the class meets every block of the rest; one of the rest every block there is.
    last = F.when(inside, F.col("r")).otherwise(F.col("r") + F.col("m")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "bucket", "id", "c", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = rows.join(sigs.select("id", "sig", "bands"), "id").join(texts, "id")
    large = rows.groupBy("bucket", "i", "j").applyInArrow(lambda t: _block_links(t, threshold, least), "a long, b long, sim double")
    return small.unionByName(large)


def _with_class(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("c", F.col("id"))
    return rows.join(labels.select(F.col("v").alias("id"), "label"), "id", "left").withColumn(
        "c", F.coalesce("label", "id")).drop("label")


def classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = THRESHOLD,
            slack: float = SLACK) -> DataFrame:
    """One row per distinct id: id, class_id (smallest id of the class) and
    n_words_shingled; the id column keeps its name."""
    scratch = Scratch(docs.sparkSession)
    signed = scratch.stored(_signed(docs, text_col, id_col), "signed")
    rows = signed.filter("n > 0 and id is not null").select("id", "k1", "k2")
    copies = scratch.stored(rows.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("times")), "copies")
    reps = copies.groupBy(F.col("rep").alias("id")).agg(F.min(F.struct("k1", "k2")).alias("k"))
    sigs = (signed.filter("n > 0").join(reps, "id").filter("k1 = k.k1 and k2 = k.k2")
            .select("id", "sig", "bands", "n"))
    # Buckets with at least two texts: (band hash, id); the band is part of its hash.
    at = sigs.select("id", F.explode("bands").alias("bucket"))
    shared = at.groupBy("bucket").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = scratch.stored(at.join(shared.select("bucket", "lead"), "bucket"), "met")
    involved = met.select("id").distinct()
    sigs = scratch.stored(sigs.join(involved, "id", "left_semi").dropDuplicates(["id"]), "sigs")
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
             .join(involved, "id", "left_semi"))
    duplicated = not signed.groupBy("id").count().filter("count > 1 and id is not null").isEmpty()
    if duplicated:  # an id with several texts stands for its first representative text
        texts = texts.groupBy("id").agg(F.min("text").alias("text"))
    texts = scratch.stored(texts, "texts")  # read in every round
    least = threshold - slack
    few = max(1, n_shuffle(docs.sparkSession) // 2)

    def best_partner(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a"))

    stars = met.select(F.col("lead").alias("a"), F.col("id").alias("b")).filter("a <> b").distinct()
    links = scratch.stored(_verified(best_partner(_estimated(stars, sigs, least)), texts, threshold).coalesce(few), "links")
    labels = components(links)
    # What a bucket still holds of different classes is compared exhaustively.
    now = _with_class(met.select("bucket", "id"), labels)
    mixed = now.groupBy("bucket").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y")
    now = scratch.stored(now.join(mixed.select("bucket"), "bucket", "left_semi"), "mixed")
    if not now.isEmpty():
        found = _exhaustive(now.join(sigs.select("id", "n"), "id"), sigs, texts, threshold, least)
        labels = components(links.unionByName(found))
    member = _with_class(copies.withColumnRenamed("rep", "id"), labels).select("k1", "k2", "c", "times")
    out = _members(signed, member).groupBy("id").agg(F.min("c").alias("class_id"), F.max("n").alias("n_shingles"))
    out = stored(out.withColumnRenamed("id", id_col), "classes")
    scratch.drop()
    return out


def _members(signed: DataFrame, member: DataFrame) -> DataFrame:
    """(id, n, c): rows with the class of their word sequence; rows without words or
    id are by themselves.  Word sequences that hold more rows than half a
    partition's share, at most two a partition, are broadcast."""
    rows = signed.select("id", "k1", "k2", "n")
    alone = (F.col("n") == 0) | F.col("id").isNull()
    total = signed.count()
    share = total / (2 * n_shuffle(signed.sparkSession))
    heavy = F.broadcast(member.filter(F.col("times") > share).select("k1", "k2", F.col("c").alias("hot")))
    marked = rows.filter(~alone).join(heavy, ["k1", "k2"], "left")
    rest = marked.filter("hot is null").drop("hot").join(member.filter(F.col("times") <= share).select("k1", "k2", "c"), ["k1", "k2"], "left")
    return (rest.select("id", "n", "c").unionByName(marked.filter("hot is not null").select("id", "n", F.col("hot").alias("c")))
            .unionByName(rows.filter(alone).select("id", "n", F.col("id").alias("c"))))


def one_per_class(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose class has a smaller id; rows that
    repeat an id count as one document, and rows without an id stay."""
    gone = stored(classes(docs, text_col, id_col, threshold).filter(F.col(id_col) != F.col("class_id")).select(id_col), "gone")
    out = docs.join(checked_broadcast(gone), id_col, "left_anti")
    twice = docs.groupBy(id_col).count().filter(f"count > 1 and {id_col} is not null").select(id_col)
    if not twice.isEmpty():
        order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last())
        again = out.join(twice, id_col, "left_semi").withColumn("__k", F.row_number().over(order))
        out = out.join(twice, id_col, "left_anti").unionByName(again.filter("__k = 1").drop("__k"))
    return out.select(*docs.columns)


def op1_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class, and whether it is the one that stays."""
    out = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), "n_shingles")
