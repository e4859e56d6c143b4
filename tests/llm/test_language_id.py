from tests.llm.helpers import SF, docs
from tripcast.llm import language_id as li
from tripcast.llm.queries import QUERIES


def _brute(model, text):
    """Greedy parse with substring tests."""
    out = []
    data = li.normalised(text)
    for sample in model.samples:
        n = 0
        for s in range(0, len(data), li.BLOCK):
            block, at = data[s:s + li.BLOCK], 0
            while at < len(block):
                size = 1
                while at + size < len(block) and block[at:at + size + 1] in sample:
                    size += 1
                at, n = at + size, n + 1
        out.append(n)
    return out


def test_phrases_equal_a_plain_parse(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.fit(d, total_bytes=8000)
    texts = [r["text"] for r in d.limit(40).collect()] + ["q", "zzz qqq", "¿日本?", "a" * 3000]
    got = {r["doc_id"]: r for r in li.predict(docs(spark, [(i, t, None) for i, t in enumerate(texts)]), model).collect()}
    for i, t in enumerate(texts):
        want = _brute(model, t)
        assert got[i]["phrases"] == min(want), t
        assert got[i]["lang_pred"] == model.langs[want.index(min(want))]


def test_held_out_accuracy(spark):
    out = QUERIES["op10_language_id"](spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = out.join(lang, "doc_id").filter("held_out").collect()
    assert rows and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "123 !?", "en"), (4, "the cat and the dog sat here", "en"),
            (4, "the cat and the dog sat here", "en"), (None, "der hund und die katze sind hier", "de"), (6, "x" * 200_000, None)]
    d = docs(spark, rows)
    model = li.fit(d)
    assert model.langs == ("de", "en")
    out = li.predict(d, model)
    assert out.columns.count("score") == 1 and "matches" in out.columns
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all(got[i][0]["lang_pred"] == "und" and got[i][0]["score"] == 0 for i in (1, 2, 3))
    assert [r["lang_pred"] for r in got[4]] == ["en", "en"] and got[None][0]["lang_pred"] == "de"
    assert got[6][0]["parsed_bytes"] == 200_000
    none = li.fit(d.limit(0))
    assert {r["lang_pred"] for r in li.predict(d, none).collect()} == {"und"}
    assert li.predict(d.limit(0), model).count() == 0


def test_text_that_no_language_explains_is_not_accepted(spark):
    d = docs(spark, [(1, "the cat and the dog sat on the mat by the door", "en"), (2, "жщцюъ эёыфй цжщюъ", None)])
    kept = li.predict(d, li.fit(d)).filter(li.accepted()).collect()
    assert [r["doc_id"] for r in kept] == [1]


def test_sample_stays_within_its_bound_whatever_the_number_of_languages(spark):
    d = docs(spark, [(i, f"word{i % 7} and more of language {i % 300} " * 20, f"l{i % 300:03d}") for i in range(1200)])
    model = li.fit(d, total_bytes=9000)
    assert len(model.langs) == 300 and all(len(s) == 30 for s in model.samples)
    sample = dict(zip(model.langs, model.samples))
    assert all(s.split(b" ")[0] for s in sample.values())
    few = li.fit(d, total_bytes=200)  # less than a byte a language
    assert len(few.langs) == 300 and set(few.samples) == {b""}
