import hashlib
import math
import random
import re
import time

from tests.llm.helpers import SF, docs
from tripcast.llm import sanitise as sa
from tripcast.llm.queries import QUERIES

PLAIN = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"),
         re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for k, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            if (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 16 <= len(d) <= 19 and _luhn(d), 8 <= len(d) <= 15)[k]:
                out.append((k, *m.span()))
    return out


def brute_terms(rows, window=sa.WINDOW, support=sa.SUPPORT, disclose=sa.DISCLOSE):
    """row -> its term spans, from counts over all pairs of entity and word."""
    word = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
    mentions, holds = [], []
    for _, text in rows:
        t = text or ""
        spans = plain_spans(t)
        free = [m.span() for m in word.finditer(t) if not any(a < m.end() and m.start() < b for _, a, b in spans)]
        mine = []
        for k, a, b in spans:
            near = [w for w in free if w[1] <= a][-window:] + [w for w in free if w[0] >= b][:window]
            mine.append((sa.entity(k, t[a:b]), [(t[x:y].lower(), x, y) for x, y in near]))
        mentions.append(mine)
        holds.append({w.lower() for w in word.findall(t)} | {m[0].lower() for m in word.finditer(t.lower())})
    out = []
    for mine in mentions:
        spots = set()
        for e, near in mine:
            n_c = sum(any(x == e for x, _ in other) for other in mentions)
            ic = math.log2(len(rows) / n_c)
            for w, x, y in near:
                having = [[ws for f, ws in other if f == e and w in [v[0] for v in ws]] for other in mentions]
                contexts = {tuple(v[0] for v in ws) for found in having for ws in found}
                n_ct, n_t = sum(map(bool, having)), sum(w in h for h in holds)
                if len(contexts) >= support and ic > 0 and math.log2(len(rows) * n_ct / (n_c * n_t)) >= disclose * ic - 1e-12:
                    spots.add((x, y))
        out.append(sorted(spots))
    return out


def _check(rows, got, terms):
    assert len(got) == len(rows)
    want = []
    for (i, text), spots in zip(rows, terms):
        base = plain_spans(text or "")
        said = [f"{sa.KINDS[k]}:{a}:{b}" for k, a, b in base]
        want.append((i, *[sum(k == n for k, _, _ in base) for n in range(4)], hashlib.sha256(",".join(said).encode()).hexdigest(),
                     ",".join(said + [f"term:{a}:{b}" for a, b in spots])))
    names = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == sorted(want, key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    _check(rows, QUERIES["op11_information_sanitising"](spark, SF).collect(), brute_terms(rows))


def test_base_spans_against_the_plain_patterns():
    rng = random.Random(1)
    bits = ["a", "b.", "@", "1", "2", "25", "255.", "0.", "007.", ".", "-", " ", "+1", "(", ")", "é", "411111111111", "1111", "%"]
    for _ in range(30_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        assert sa.base_spans(text) == plain_spans(text), text


def test_long_texts_take_linear_time():
    n = 300_000
    for text in ("a" * n, "1" * n, "1." * n, "a@" * n, "+1 " * n, "+1" + "1-" * n, "1 " * n, "a.b@" + "c." * n, "+" * n, "a." * n):
        began = time.perf_counter()
        sa.base_spans(text)
        assert time.perf_counter() - began < 10, text[:8]


def _corpus():
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(30)]
    say = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows = [(i, say(40)) for i in range(60)]
    # "zanzibar" stands by one address only, "common" by it and elsewhere, "Once" in a single context
    rows += [(100 + i, f"{say(6)} zanzibar common ann@mail.example.com {say(12)}") for i in range(30)]
    rows += [(200 + i, f"{say(10)} common {say(5)}") for i in range(10)]
    rows += [(300 + i, f"Once upon bob@mail.example.com {' '.join(filler[:9])}") for i in range(5)]
    return rows


def test_disclosing_words_are_found_where_their_entity_is(spark):
    rows = _corpus() + [(400, "zanzibar alone"), (401, None), (402, ""), (403, "ann@mail.example.com"), (100, "no data"), (None, "+1 (555) 123-4567")]
    got = sa.sanitise(docs(spark, [(i, t, "en") for i, t in rows])).collect()
    terms = brute_terms(rows)
    _check(rows, got, terms)
    by_id = {r["doc_id"]: r for r in got}
    assert sum(map(len, terms)) >= 4 and any("zanzibar" in t[a:b] for (_, t), s in zip(rows, terms) for a, b in s)
    assert by_id[400]["n_term"] == 0  # no entity there
    assert by_id[300]["n_term"] == 0  # one context, five copies
    assert "ann@" not in by_id[102]["sanitised"] and "zanzibar" not in by_id[102]["sanitised"] and "[EMAIL]" in by_id[102]["sanitised"]
    assert by_id[401]["sanitised"] == "" and by_id[None]["sanitised"] == "[PHONE]"


def test_repeated_rows_and_no_rows(spark):
    rows = _corpus()
    rows += [rows[61]] * 3
    _check(rows, sa.sanitise(docs(spark, [(i, t, "en") for i, t in rows])).collect(), brute_terms(rows))
    assert sa.sanitise(docs(spark, [])).collect() == []


def test_replacing():
    assert sa.replaced("Ann 12 lives at a@b.c here", [("email", 16, 21, False), ("term", 0, 3, False), ("term", 4, 6, False),
                                                      ("term", 7, 12, True)]) == "[NAME] [NUMBER]  at [EMAIL] here"
    assert sa.replaced("+1 10.0.0.1", [("ip", 3, 11, False), ("phone", 0, 11, False)]) == "[PHONE]"
