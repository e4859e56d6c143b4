import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF
from tripcast.llm import chat
from tripcast.llm.queries import QUERIES

TURNS = "id long, turns array<struct<role:string,text:string>>"


def _sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_layouts_are_recognised_by_their_fields(spark):
    rows = [{"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]},
            {"response": "r", "prompt": "p"}, {"output": "o", "instruction": "i", "input": ""},
            {"output": "o", "instruction": "i", "input": "more"}, {"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}]},
            {"system": "s", "instruction": "i", "output": "o"}, {"question": 5, "answer": None}, {"something": {"else": [1, {"q": 2}]}}]
    d = spark.createDataFrame([(i, json.dumps(r), "k") for i, r in enumerate(rows)] + [(90, "no json", "k"), (91, None, "k")],
                              "id long, doc string, layout string")
    got = {r["id"]: r for r in chat.from_json(d, "doc").collect()}
    u, a = "user", "assistant"
    want = {0: ("messages", [(u, "a"), (a, "b")]), 1: ("prompt_response", [(u, "p"), (a, "r")]), 2: ("instruction_input", [(u, "i"), (a, "o")]),
            3: ("instruction_input", [(u, "i\nmore"), (a, "o")]), 4: ("conversations", [(u, "x"), (a, "y")]),
            5: ("system_instruction", [("system", "s"), (u, "i"), (a, "o")]), 6: ("question_answer", [(u, "5"), (a, None)])}
    for i, (layout, turns) in want.items():
        assert got[i]["layout"] == layout and [tuple(t) for t in got[i]["turns"]] == turns
    assert got[7]["layout"] is None and got[7]["turns"] is None and got[7]["schema_sha256"]
    assert got[90]["schema_sha256"] is None and got[91]["schema_sha256"] is None
    assert chat.from_json(d.limit(0), "doc").count() == 0


def test_columns_give_the_same_fingerprint_as_json(spark):
    d = spark.createDataFrame([("p", "r", 7)], "response string, prompt string, key long")
    assert [tuple(t) for t in chat.from_columns(d, key="key").first()["turns"]] == [("user", "r"), ("assistant", "p")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.from_columns(d)


def test_a_table_of_turns_is_a_mapping_like_the_others(spark):
    d = spark.createDataFrame([(1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "y")], "conv_id long, turn long, role string, text string, turns string")
    assert [tuple(t) for t in chat.from_columns(d, ignore=("turns",)).first()["turns"]] == [("user", "a"), ("assistant", "b")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.from_columns(d)
    own = chat.Mapping("lines", ("thread", "line"), "transform(array_sort(v), m -> named_struct('role', 'user', 'text', m.l))",
                       group="thread", element="named_struct('l', line)")
    lines = spark.createDataFrame([("t", "z"), ("t", "a")], "thread string, line string")
    assert [t["text"] for t in chat.from_columns(lines, mappings=(own,)).first()["turns"]] == ["a", "z"]


def test_empty_message_lists_have_a_mapping(spark):
    d = spark.createDataFrame([(1, '{"messages": []}'), (2, '{"conversations": []}')], "id long, doc string")
    got = {r["id"]: r for r in chat.formatted(chat.from_json(d, "doc")).collect()}
    assert (got[1]["layout"], got[1]["turns"], got[1]["formatted"]) == ("messages", [], "") and got[2]["layout"] == "conversations"


def test_formatting_is_reversible(spark):
    random.seed(3)
    parts = ["<", "[", "\\", "|", "/", "s>", "INST]", "<SYS>>", "a", "</s>", "<|end|>", "<|text|>", "<|turn|>", "\n", "é", "😀", "$1"]
    made = [[(r, "".join(random.choices(parts, k=random.randrange(14)))) for r in ("user", "assistant", "<|x", "assistant")] for _ in range(800)]
    d = spark.createDataFrame(list(enumerate(made)), TURNS)
    out = chat.formatted(d).withColumn("back", chat.read_back(F.col("formatted"))).withColumn(
        "loss", F.transform("loss_spans", lambda s: chat.unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))))
    for r in out.collect():
        assert [tuple(t) for t in r["back"]] == [tuple(t) for t in r["turns"]]
        assert r["loss"] == [t for role, t in made[r["id"]] if role == "assistant"]
        assert r["formatted"].count("<|") == 3 * 4 and "</s>" not in r["formatted"] and "[INST]" not in r["formatted"]


def test_edge_cases(spark):
    d = spark.createDataFrame([(1, 1, "user", None), (1, 0, None, "x"), (1, None, "system", "first"), (2, 0, "user", "a"), (2, 0, "user", "a"),
                               (2, 0, "assistant", "tie"), (None, 0, "user", "y" * 300_000)], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.from_columns(d).collect()}
    assert got[1] == [("system", "first"), ("", "x"), ("user", "")]
    assert got[2] == [("assistant", "tie"), ("user", "a"), ("user", "a")] and len(got[None][0][1]) == 300_000
    assert chat.from_columns(d.limit(0)).count() == 0
    none = chat.formatted(spark.createDataFrame([(1, None), (2, [])], TURNS)).collect()
    assert all(r["formatted"] == "" and r["loss_spans"] == [] for r in none)


def test_query(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    df = QUERIES["op7_chat_format"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {r["conv_id"]: r for r in df.collect()}
    assert set(got) == set(turns)
    for i, t in turns.items():
        t.sort()
        loss = "".join(x for _, role, x in t if role == "assistant")
        r = got[i]
        assert (r["n_turns"], r["turns_sha256"]) == (len(t), _sha("".join(f"{role}\n{x}\n" for _, role, x in t)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), _sha(loss))
        assert r["formatted_chars"] >= sum(len(role) + len(x) for _, role, x in t)
