"""Small inputs and plain-Python twins shared by the tests."""

import re
from collections import Counter

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, matches string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with outputs."""
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 7.0, "x") for i, t, lang in rows], DOCS)


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    if len(w) >= 5:
        return Counter(zip(*[w[k:] for k in range(5)]))
    return Counter([tuple(w)]) if w else Counter()


def classes(rows, threshold=0.8):
    """doc id -> smallest id of its near-duplicate class, by comparing all pairs
    that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    for a, b in {(a, b) for v in where.values() for a in v for b in v if a < b}:
        common = sum((sets[a] & sets[b]).values())
        if common / (sum(sets[a].values()) + sum(sets[b].values()) - common) >= threshold:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}
