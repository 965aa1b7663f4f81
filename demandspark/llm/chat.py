"""Chat formatting: records of many layouts become canonical turns, and turns become text.

A layout is known by its fingerprint, the hash of its nested field paths: of the type
for struct columns, of each record for JSON strings.  The fingerprint selects a
declarative mapping from fields to turns.  All of it are DataFrame expressions.

Template, per turn: ``### role: text</turn>`` and a line feed.  Inside roles and texts
a backslash is put before every backslash, into ``</turn>`` (``<\\/turn>``) and into
every ``###`` (``#\\##``), and before every colon of a role, so that control strings
never occur in them; taking the backslashes out again restores them.  The loss mask
holds start and length (code points, from 1) of every assistant text.

Defined results: a null text or role is empty.  Turns with equal numbers are ordered by
role and text; a null number comes last.  Rows with a null conversation id are one
conversation.  A record whose fingerprint is not known, or that isn't JSON, has null
turns, so that it can be told from one without turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A known layout: its field paths, and where the turns are.

    ``each`` names an array and its role and text fields; ``fields`` lists (role, field)
    of flat layouts, of which the empty ones are left out, except for the last.
    """

    paths: Sequence[str]
    each: tuple[str, str, str] | None = None
    fields: Sequence[tuple[str, str]] = ()
    roles: Mapping[str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


#: Roles of layouts that name them otherwise.
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout(("messages[].content", "messages[].role"), each=("messages", "role", "content")),
    Layout(("turns[].role", "turns[].text"), each=("turns", "role", "text")),
    Layout(("conversations[].from", "conversations[].value"), each=("conversations", "from", "value"), roles=SPEAKERS),
    Layout(("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout(("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout(("prompt", "response", "system"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout(("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Layout(("input", "instruction", "output"), fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def type_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type; arrays add ``[]``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in type_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return type_paths(kind.elementType, f"{at}[]")
    return [at]


def _keys(json: Column) -> Column:
    return F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))


def json_fingerprint(record: Column) -> Column:
    """The fingerprint of a JSON record: its fields, and those of the objects in its arrays."""

    fields = F.from_json(record, "map<string,string>")

    def below(key: Column) -> Column:
        items = F.from_json(fields[key], "array<string>")
        keys = F.array_distinct(F.flatten(F.transform(items, _keys)))
        return F.when(items.isNull(), F.array(key)).otherwise(F.transform(keys, lambda k: F.concat(key, F.lit("[]."), k)))

    return F.md5(F.array_join(F.array_sort(F.flatten(F.transform(_keys(record), below))), "\n"))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _alias(role: Column, roles: Mapping[str, str] | None) -> Column:
    for old, new in (roles or {}).items():
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def _mapped(layout: Layout, field, items) -> Column:
    """A layout's turns; ``field`` reads a flat field, ``items`` an array of (role, text)."""
    if layout.each:
        return F.transform(items(*layout.each), lambda x: _turn(_alias(x["role"], layout.roles), x["text"]))
    turns = [_turn(F.lit(role), field(name)) for role, name in layout.fields]
    return F.filter(F.array(*turns), lambda t, i: (t["text"] != "") | (i == len(turns) - 1))


def canonical_turns(df: DataFrame, record: str, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Turns of the column ``record``, a struct or a JSON string, by the mapping its fingerprint selects."""
    kind, column = df.schema[record].dataType, F.col(f"`{record}`")
    known = {x.fingerprint: x for x in layouts}
    if isinstance(kind, T.StructType):
        layout = known.get(fingerprint(type_paths(kind)))
        if layout is None:
            return F.lit(None).cast(TURNS)
        items = lambda name, role, text: F.transform(column[name], lambda x: F.struct(x[role].alias("role"), x[text].alias("text")))
        return F.when(column.isNotNull(), F.coalesce(_mapped(layout, lambda name: column[name], items), F.array().cast(TURNS)))

    def items(name: str, role: str, text: str) -> Column:
        parsed = F.from_json(column, f"struct<`{name}`:array<struct<`{role}`:string,`{text}`:string>>>")
        return F.transform(parsed[name], lambda x: F.struct(x[role].alias("role"), x[text].alias("text")))

    turns, found = F.lit(None).cast(TURNS), json_fingerprint(column)
    for key, layout in known.items():
        flat = lambda name: F.get_json_object(column, f"$['{name}']")
        turns = F.when(found == key, _mapped(layout, flat, items)).otherwise(turns)
    return turns


def escape(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    text = F.regexp_replace(text, "#(?=##)", "#\\\\")
    return F.replace(text, F.lit(":"), F.lit("\\:")) if role else text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: Column) -> tuple[Column, Column]:
    """The text of all turns, and the loss mask: start and length of the assistant texts."""
    parts = F.transform(
        turns, lambda t: F.struct(F.concat(F.lit("### "), escape(t["role"], role=True), F.lit(": ")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss"))
    )
    text = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        body = state["at"] + F.length(p["head"])
        span = F.struct(body.alias("start"), F.length(p["body"]).alias("length"))
        return F.struct((body + F.length(p["body"]) + len(END)).alias("at"), F.when(p["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return text, F.aggregate(parts, zero, step)["spans"]


def parsed(text: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.slice(F.split(text, END), F.lit(1), F.greatest(F.size(F.split(text, END)) - 1, F.lit(0)))
    pattern = r"(?s)^### ((?:[^\\:]|\\.)*+): (.*)$"
    return F.transform(pieces, lambda p: F.struct(unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))


def format_records(df: DataFrame, record: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``df`` with turns, formatted and loss_mask."""
    df = df.withColumn("turns", canonical_turns(df, record, layouts))
    text, mask = formatted(F.col("turns"))
    return df.withColumns({"formatted": text, "loss_mask": mask})


def conversations_from_rows(rows: DataFrame) -> DataFrame:
    """One record of the messages layout for each conversation of a table of turns.

    A conversation is one text in the end, so that its rows have to meet.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn").isNull().alias("last"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))))
    messages = F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return rows.groupBy("conv_id").agg(F.struct(messages.alias("messages")).alias("record"))


def chat_digest(rows: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text and its loss mask."""
    done = format_records(conversations_from_rows(rows), "record")
    turns = parsed(F.col("formatted"))
    loss = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substring("formatted", s["start"], s["length"]))), "")
    return done.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
