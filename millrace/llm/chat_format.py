"""Chat records of any known layout as canonical turns and one training text; DataFrame functions only."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of this and other templates; in a text a backslash goes behind their first character.
_CONTROL = r"([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|</?SYS>>|/?INST\])"
_SCALARS = r"\b(STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|BINARY|DATE|TIMESTAMP_NTZ|TIMESTAMP|UUID|DECIMAL\(\d+,\s*\d+\))(?=[,>]|$)"


@dataclass(frozen=True)
class Mapping:
    """How records with the field paths of ``example`` become turns: a list of turns at ``turns``, or single ``parts``."""

    name: str
    example: str
    turns: str = ""
    role: str = ""
    text: str = ""
    parts: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


_SHARE_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("messages", '{"messages": [{"role": "", "content": ""}]}', "$.messages", "role", "content", roles=_SHARE_ROLES),
    Mapping("messages with text", '{"messages": [{"role": "", "text": ""}]}', "$.messages", "role", "text", roles=_SHARE_ROLES),
    Mapping("shared chat", '{"conversations": [{"from": "", "value": ""}]}', "$.conversations", "from", "value", roles=_SHARE_ROLES),
    Mapping("prompt", '{"prompt": "", "completion": ""}', parts=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("prompt and response", '{"prompt": "", "response": ""}', parts=(("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("system prompt", '{"system": "", "prompt": "", "completion": ""}', parts=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("instruction", '{"instruction": "", "output": ""}', parts=(("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("instruction with input", '{"instruction": "", "input": "", "output": ""}', parts=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Mapping("question", '{"question": "", "answer": ""}', parts=(("user", "$.question"), ("assistant", "$.answer"))),
    Mapping("nested answer", '{"question": {"text": ""}, "answer": {"text": ""}}', parts=(("user", "$.question.text"), ("assistant", "$.answer.text"))),
)
#: Tables with a row per turn: the columns that hold conversation, place, role and text.
TURN_TABLES = (("conv_id", "turn", "role", "text"), ("conversation_id", "turn", "role", "content"), ("conversation_id", "message_index", "from", "value"))


def record_fingerprint(record: Column) -> Column:
    """A hash of the nested field paths of a VARIANT, whatever the types of its values and the order of its fields."""
    return F.sha2(F.regexp_replace(F.schema_of_variant(record), _SCALARS, "_"), 256)


def _names_hash(names) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def table_fingerprint(schema: T.StructType, known: tuple[str, ...]) -> str:
    """A hash of those top-level field paths that are among ``known``; further columns do not matter."""
    return _names_hash({f.name for f in schema} & set(known))


def turns_of_table(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of a table with a row per turn; the fingerprint of its schema picks the mapping.

    The first mapping counts whose columns are all there; columns of other mappings, or any others, change nothing.
    """
    for names in TURN_TABLES:
        if table_fingerprint(rows.schema, names) == _names_hash(names):
            conv, turn, role, text = names
            return rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    raise ValueError("no mapping for these columns: " + ", ".join(rows.columns))


def _canonical(m: Mapping):
    def turn(x):
        role = x[m.role]
        for old, new in m.roles.items():
            role = F.when(x[m.role] == old, new).otherwise(role)
        return F.struct(role.alias("role"), x[m.text].alias("text"))

    return turn


def turns_of_records(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records ``conv_id, record``, and the records no mapping fits (``conv_id, record, reason``).

    Each record's own fingerprint picks its mapping. ``record`` is NULL or unreadable: reason ``no record``; a layout nobody
    declared, an empty list of turns included: ``unknown layout``. A NULL or missing value in a known layout is an empty text.
    """
    parsed = records.select("conv_id", "record", F.try_parse_json("record").alias("v")).withColumn("print", record_fingerprint(F.col("v")))
    turn = "array<struct<role:string,text:string>>"
    turns, known = F.lit(None).cast(turn), F.lit(False)
    for m in mappings:
        if m.turns:
            got = F.try_variant_get("v", m.turns, f"array<struct<`{m.role}`:string,`{m.text}`:string>>")

            made = F.transform(got, _canonical(m))
        else:
            made = F.array(*[F.struct(F.lit(role).alias("role"), F.try_variant_get("v", path, "string").alias("text")) for role, path in m.parts])
        fits = F.col("print") == record_fingerprint(F.parse_json(F.lit(m.example)))
        turns, known = F.when(fits, made.cast(turn)).otherwise(turns), known | fits
    marked = parsed.select("conv_id", "record", "v", turns.alias("turns"), F.coalesce(known, F.lit(False)).alias("known"))
    reason = F.when(F.col("v").isNull(), "no record").otherwise("unknown layout")
    rejected = marked.filter("NOT known").select("conv_id", "record", reason.alias("reason"))
    rows = marked.filter("known").select(F.col("conv_id").cast("long").alias("conv_id"), F.posexplode("turns").alias("turn", "t"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text"), rejected


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def formatted(turns: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``: one text per conversation, and where in it (code points from 0) the loss counts.

    ``turns`` has ``conv_id, turn, role, text``. Turns are in order of ``turn`` (NULL first; ties by role, then text), repeated rows
    are repeated turns, NULL roles and texts are empty, a NULL conv_id is one conversation. Roles and texts are escaped,
    so marks in the output are the template's own. The loss covers each text of ``learned_role``, without marks.
    """
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    rows = turns.select("conv_id", "turn", "role", F.col("text").alias("raw"), role.alias("r"), text.alias("t"))
    rows = rows.withColumn("piece", F.concat(F.lit(TURN), "r", F.lit(TEXT), "t", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    before = F.coalesce(F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + len(TURN) + F.length("r") + len(TEXT)
    span = F.when(F.col("role") == learned_role, F.struct(start.alias("start"), F.length("t").cast("long").alias("length")))
    rows = rows.select("conv_id", F.row_number().over(order).alias("place"), "piece", span.alias("span"))
    out = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "piece", "span"))).alias("parts"))
    spans = F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull())
    return out.select("conv_id", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def parsed(chats: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, learned``: the turns read back from ``formatted``, and the texts under ``loss_spans``."""
    parts = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda p: p != "")

    def turn(p):
        text = F.substring_index(F.substring_index(p, TEXT, -1), END, 1)
        return F.struct(unescaped(F.substring_index(p, TEXT, 1)).alias("role"), unescaped(text).alias("text"))

    learned = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", "formatted", F.transform(parts, turn).alias("turns"), learned.alias("learned"))
