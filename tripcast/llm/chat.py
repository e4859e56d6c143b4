"""Chat formatting with schema fingerprints, on DataFrame functions only.

Heterogeneous layouts become canonical turns, array<struct<role, text>>, by
declarative mappings.  A layout is recognised by its schema fingerprint: the
SHA-256 of its sorted nested field paths (``messages[].role``), so neither
field order nor types nor values matter.  A mapping names the fingerprint's
paths and how they become turns:

* :func:`from_json`: one JSON document per row, layouts mixed freely.  The
  paths come from ``schema_of_variant`` row by row.
* :func:`from_columns`: a DataFrame of one layout; the paths come from its
  schema.  A table of single turns is one of the layouts: its mapping also names the
  column that groups rows and what of each row is gathered.

Rows whose fingerprint has no mapping keep null turns and their fingerprint, so
they can be counted and a mapping added; nothing is dropped.

:func:`formatted` renders turns as ``<|turn|>role<|text|>text<|end|>``.  A
control string inside a role or text gets a backslash behind its first
character (one more where it has some), which :func:`unescaped` takes away
again, so the output holds control strings only where the template put them.
The loss mask is a list of spans, in code points of the output, one for each
assistant text.  :func:`read_back` splits the output into turns again.

Edge cases: null text or role is empty; a conversation without turns is an
empty string; turns are ordered by their number, ties by role, then text, and
repeated rows stay repeated turns; turns without a number come first.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.common import table

TURNS = "array<struct<role:string,text:string>>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Strings that chat templates in use give a meaning.
# <|...|> marks, <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>
CONTROL_TAIL = r"\||/?s>|/?INST\]|</?SYS>>"


def escaped(text: Column) -> Column:
    """One more backslash behind the first character of every control string."""
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={CONTROL_TAIL})", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={CONTROL_TAIL})", "$1$2")


def _paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a Spark type; ``[]`` marks an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in _paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return _paths(kind.elementType, prefix + "[]")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths and how it becomes turns, SQL over ``v``, a
    variant or struct with these fields.  Where rows are parts of a conversation,
    ``group`` is the column they share and ``v`` the array of their ``element``."""
    name: str
    paths: tuple[str, ...]
    turns: str
    group: str | None = None
    element: str = ""

    @property
    def fingerprint(self) -> str:
        return fingerprint(list(self.paths))

    @property
    def fingerprints(self) -> list[str]:
        """Its fingerprint, and that of the layout with empty lists, which show no fields."""
        bare = [p.partition("[].")[0] + "[]" if "[]." in p else p for p in self.paths]
        return [self.fingerprint, fingerprint(bare)]


def _listed(path: str, role: str, text: str) -> str:
    return f"transform({path}, m -> named_struct('role', {role}, 'text', m.{text}))"


# How sharing formats in use name their roles.
# human -> user, gpt -> assistant, bot -> assistant, model -> assistant
ROLE = ("case lower(m.{0}) when 'human' then 'user' when 'gpt' then 'assistant' when 'bot' then 'assistant' "
        "when 'model' then 'assistant' else m.{0} end")


def _pair(user: str, assistant: str) -> str:
    return (f"array(named_struct('role', 'user', 'text', {user}), "
            f"named_struct('role', 'assistant', 'text', {assistant}))")


MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), _listed("array_sort(v)", "m.role", "text"), group="conv_id",
            element="named_struct('turn', turn, 'role', coalesce(role, ''), 'text', coalesce(text, ''))"),
    Mapping("messages", ("messages[].role", "messages[].content"), _listed("v.messages", "m.role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"),
            _listed("v.conversations", ROLE.format("from"), "value")),
    Mapping("prompt_response", ("prompt", "response"), _pair("v.prompt", "v.response")),
    Mapping("prompt_completion", ("prompt", "completion"), _pair("v.prompt", "v.completion")),
    Mapping("question_answer", ("question", "answer"), _pair("v.question", "v.answer")),
    Mapping("instruction", ("instruction", "output"), _pair("v.instruction", "v.output")),
    Mapping("instruction_input", ("instruction", "input", "output"),
            _pair("concat_ws('\n', v.instruction, nullif(v.input, ''))", "v.output")),
    Mapping("system_instruction", ("system", "instruction", "output"),
            "concat(array(named_struct('role', 'system', 'text', v.system)), " + _pair("v.instruction", "v.output") + ")"),
)


def _fields(mapping: Mapping) -> str:
    """Schema of the mapping's variant: every leaf a string."""
    lists: dict[str, list[str]] = {}
    for p in mapping.paths:
        head, _, leaf = p.partition("[].")
        lists.setdefault(head, []).extend([leaf] if leaf else [])
    return "struct<" + ",".join(
        f"{h}:array<struct<{','.join(f'{x}:string' for x in leaves)}>>" if leaves else f"{h}:string"
        for h, leaves in lists.items()) + ">"


def _variant_fingerprint(v: Column) -> Column:
    """Fingerprint of one variant.  ``schema_of_variant`` prints e.g.
    ``OBJECT<a: STRING, m: ARRAY<OBJECT<r: STRING>>>`` with sorted fields; the
    paths are read off by opening and closing brackets, which a fold does with
    a stack of prefixes."""
    printed = F.schema_of_variant(v)
    # One entry per name, opening and closing: `name: OBJECT<`, `name: STRING`, `>`.
    tokens = F.regexp_extract_all(printed, F.lit(r"(?:(?:`[^`]*`|[^:<>,` ]+): )?(?:OBJECT<|ARRAY<|[A-Z_]+(?:\(\d+,\d+\))?)|>"), F.lit(0))
    start = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast("array<string>").alias("paths"))

    def step(s: Column, token: Column) -> Column:
        name = F.regexp_replace(F.regexp_extract(token, r"^(`[^`]*`|[^:<>,` ]+): ", 1), "`", "")
        top = F.when(F.size(s["stack"]) > 0, F.element_at(s["stack"], -1)).otherwise(F.lit(""))
        path = F.when(name == "", top).when(top == "", name).otherwise(F.concat(top, F.lit("."), name))
        opened = F.when(token.endswith("ARRAY<"), F.concat(path, F.lit("[]"))).otherwise(path)
        return (F.when(token == ">", F.struct(F.slice(s["stack"], 1, F.greatest(F.size(s["stack"]) - 1, F.lit(0))).alias("stack"),
                                              s["paths"].alias("paths")))
                .when(token.endswith("<"), F.struct(F.concat(s["stack"], F.array(opened)).alias("stack"), s["paths"].alias("paths")))
                .otherwise(F.struct(s["stack"].alias("stack"), F.concat(s["paths"], F.array(path)).alias("paths"))))

    paths = F.aggregate(tokens, start, step, lambda s: s["paths"])
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"), 256)


def from_json(rows: DataFrame, json_col: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``rows`` with ``layout`` (the mapping's name), ``schema_sha256`` and
    ``turns``; text that is not JSON has null in all three."""
    keep = [c for c in rows.columns if c not in ("layout", "schema_sha256", "turns")]
    d = rows.withColumn("__v", F.try_parse_json(F.col(json_col)))
    d = d.withColumn("schema_sha256", F.when(F.col("__v").isNotNull(), _variant_fingerprint(F.col("__v"))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        if m.group:
            continue
        mine = F.col("schema_sha256").isin(m.fingerprints)
        fields = f"try_variant_get(__v, '$', '{_fields(m)}')"
        whole = F.expr(f"transform(array({fields}), v -> {m.turns})[0]").cast(TURNS)
        layout, turns = F.when(mine, m.name).otherwise(layout), F.when(mine, whole).otherwise(turns)
    return d.select(*keep, layout.alias("layout"), "schema_sha256", turns.alias("turns"))


def from_columns(rows: DataFrame, key: str | None = None, mappings: tuple[Mapping, ...] = MAPPINGS,
                 ignore: tuple[str, ...] = ()) -> DataFrame:
    """(key, turns) of a DataFrame whose schema, apart from ``key`` and the columns to
    ``ignore``, has a mapping's fingerprint; raises ValueError where there is none.
    The key of a table of single turns is the column that groups them."""
    rows = rows.drop(*ignore)
    kinds = rows.schema
    without = T.StructType([f for f in kinds.fields if f.name != key])
    for m in mappings:
        turns = F.expr(f"transform(array(__v), v -> {m.turns})[0]").cast(TURNS).alias("turns")
        if m.group and fingerprint(_paths(kinds)) == m.fingerprint:
            return rows.groupBy(m.group).agg(F.collect_list(F.expr(m.element)).alias("__v")).select(m.group, turns)
        if not m.group and fingerprint(_paths(without)) == m.fingerprint:
            own = [key] if key else []
            return rows.select(*own, F.struct(*without.names).alias("__v")).select(*own, turns)
    raise ValueError(f"no mapping for the field paths {sorted(set(_paths(kinds)))}")


def formatted(turns: DataFrame, turns_col: str = "turns") -> DataFrame:
    """``turns`` with ``formatted`` (string) and ``loss_spans``, array<struct<
    start, length>>: from 0, in code points, the escaped assistant texts."""
    keep = [c for c in turns.columns if c not in ("formatted", "loss_spans")]
    pieces = F.transform(F.coalesce(F.col(turns_col), F.array().cast(TURNS)), lambda t: F.struct(
        (F.coalesce(t["role"], F.lit("")) == "assistant").alias("loss"),
        F.concat(F.lit(TURN), escaped(F.coalesce(t["role"], F.lit(""))), F.lit(TEXT)).alias("head"),
        escaped(F.coalesce(t["text"], F.lit(""))).alias("text")))
    d = turns.select(*keep, pieces.alias("__p"))
    whole = F.array_join(F.transform("__p", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s: Column, p: Column) -> Column:
        begin, n = s["at"] + F.char_length(p["head"]), F.char_length(p["text"])
        span = F.array(F.struct(begin.cast("int").alias("start"), n.cast("int").alias("length")))
        return F.struct((begin + n + len(END)).cast("int").alias("at"),
                        F.when(p["loss"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return d.select(*keep, whole.alias("formatted"), F.aggregate("__p", zero, step, lambda s: s["spans"]).alias("loss_spans"))


def read_back(output: Column) -> Column:
    """The turns of a formatted string."""
    pieces = F.filter(F.split(output, r"<\|end\|>"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, len(TURN) + 1, 2_147_483_647), TEXT, 1)).alias("role"),
        unescaped(F.substring_index(p, TEXT, -1)).alias("text")))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    # The table is one layout, a row per turn; the added conversation comes as another, a JSON document of messages.
    messages = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(said).alias("content")) for role in ("user", "assistant")])
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.to_json(F.struct(messages.alias("messages"))).alias("doc"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = from_columns(rows).unionByName(from_json(extra, "doc").select("conv_id", "turns"))
    out = formatted(turns).select("conv_id", "formatted", "loss_spans")
    turns = read_back(F.col("formatted"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    printed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.withColumn("turns", turns).withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(printed, 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))
