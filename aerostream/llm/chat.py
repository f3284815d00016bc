"""Chat formatting by schema fingerprints.

``canonical`` takes JSON records of any known layout: the sorted nested field
paths of a record are hashed, the hash selects a declarative mapping, and the
mapping says which fields make up the turns. ``formatted`` renders turns with a
template, ``read_back`` parses its output.

Template, per turn: ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line
feed. Inside roles and texts a ``<`` followed by any number of backslashes and
a ``|`` gets one more backslash, so control strings never occur in them;
reading takes one away. The loss mask lists where assistant texts lie in the
output (code points, escaped text).

Defined results: null role or text counts as empty; turns are ordered by turn
(null first), role, text; repeated rows are turns of their own; a record whose
fingerprint has no mapping, or a damaged one, has null turns and layout
``unknown``; a conversation is one row, however long. SQL functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"

# layout -> (nested field paths, how its fields become turns): either
# ("fields", [(role, field), ...]) or ("list", field, role key, text key, {role names})
SHARE_ROLES = {"human": "user", "gpt": "assistant", "system": "system"}
LAYOUTS = {
    "completion": (["completion", "prompt"], ("fields", [("user", "prompt"), ("assistant", "completion")])),
    "instruction": (["input", "instruction", "output"],
                    ("fields", [("system", "instruction"), ("user", "input"), ("assistant", "output")])),
    "share": (["conversations[].from", "conversations[].value"], ("list", "conversations", "from", "value", SHARE_ROLES)),
    "messages": (["messages[].content", "messages[].role"], ("list", "messages", "role", "content", {})),
}


def path_hash(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprint(raw: Column) -> Column:
    """Hash of the record's nested field paths; a list counts by its first item."""
    keys = F.json_object_keys(raw)

    def paths(k: Column) -> Column:
        inner = F.json_object_keys(F.call_function("get_json_object", raw, F.concat(F.lit("$['"), k, F.lit("'][0]"))))
        return F.coalesce(F.transform(inner, lambda x: F.concat(k, F.lit("[]."), x)), F.array(k))

    return F.sha2(F.array_join(F.array_sort(F.flatten(F.transform(keys, paths))), "\n"), 256)


def _turn_of(role_key: str, text_key: str, renamed) -> Callable[[Column], Column]:
    return lambda m: F.struct(renamed(m[role_key]).alias("role"), m[text_key].alias("text"))


def canonical(records: DataFrame, raw_col: str = "record", layouts: dict | None = None) -> DataFrame:
    """Add layout and turns to JSON records."""
    layouts = layouts or LAYOUTS
    raw = F.col(raw_col)
    fields, lists = set(), set()
    for _, (kind, *rest) in layouts.values():
        fields |= {f for _, f in rest[0]} if kind == "fields" else set()
        lists |= {tuple(rest[:3])} if kind == "list" else set()
    schema = ", ".join([f"`{f}` string" for f in sorted(fields)]
                       + [f"`{f}` array<struct<`{r}`:string,`{t}`:string>>" for f, r, t in sorted(lists)])
    out = records.withColumn("_print", fingerprint(raw)).withColumn("_j", F.from_json(raw, schema))
    layout, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
    for name, (paths, (kind, *rest)) in layouts.items():
        if kind == "fields":
            t = F.array(*[F.struct(F.lit(role).alias("role"), F.col(f"_j.{f}").alias("text")) for role, f in rest[0]])
        else:
            f, r, x, roles = rest

            def renamed(c: Column, roles=roles) -> Column:
                for old, new in roles.items():
                    c = F.when(c == old, F.lit(new)).otherwise(c) if old != new else c
                return c

            t = F.transform(F.col(f"_j.{f}"), _turn_of(r, x, renamed))
        hit = F.col("_print") == F.lit(path_hash(paths))
        layout = F.when(hit, F.lit(name)).otherwise(layout)
        turns = F.when(hit, t.cast(TURNS)).otherwise(turns)
    return out.withColumn("layout", layout).withColumn("turns", turns).drop("_print", "_j")


def grouped(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows by turn -> (conv_id, turns)."""
    t = F.struct(F.col(turn_col).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(t)).alias("_t")) \
        .select("conv_id", F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def as_records(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) -> (conv_id, record): JSON in the layouts that users
    send, by the shape of the conversation."""
    turns = F.col("turns")
    roles = F.transform(turns, lambda x: x["role"])
    text = lambda i: turns[i]["text"]
    old = {v: k for k, v in SHARE_ROLES.items()}
    known = F.size(F.array_except(roles, F.array(*[F.lit(x) for x in old]))) == 0

    def back(c: Column) -> Column:
        for new, name in old.items():
            c = F.when(c == new, F.lit(name)).otherwise(c) if new != name else c
        return c

    share = F.to_json(F.struct(F.transform(turns, lambda x: F.struct(
        back(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations")))
    messages = F.to_json(F.struct(F.transform(turns, lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    return convs.select("conv_id", F.when(
        roles == F.array(F.lit("user"), F.lit("assistant")),
        F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion")))).when(
        roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")),
        F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output")))).when(
        known & (F.size(turns) % 2 == 1), share).otherwise(messages).alias("record"))


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def _running(xs: Column) -> Column:
    """(total, before) of an array of longs: before lists the sum of those before each."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("before"))
    return F.aggregate(xs, zero, lambda acc, x: F.struct(
        (acc["total"] + x).alias("total"), F.concat(acc["before"], F.array(acc["total"])).alias("before")))


def _stretches(xs: Column) -> Column:
    """An array cut into stretches, as many as a stretch has items: work that grows
    with the square of a stretch grows only little faster than the array."""
    n = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs)))).cast("int")
    return F.when(F.size(xs) == 0, F.array(xs)).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / n).cast("int")), lambda i: F.slice(xs, i * n + 1, n)))


def formatted(convs: DataFrame) -> DataFrame:
    """Add formatted (text) and loss_spans (start, length; from 0) to turns."""
    safe = F.transform("turns", lambda x: F.struct(
        F.coalesce(x["role"], F.lit("")).alias("role"), escaped(F.coalesce(x["role"], F.lit(""))).alias("r"),
        escaped(F.coalesce(x["text"], F.lit(""))).alias("t")))
    rendered = F.transform(F.col("_safe"), lambda x: F.concat(
        F.lit(START), x["r"], F.lit(SEP), x["t"], F.lit(END + "\n")))
    around = len(START) + len(SEP) + len(END) + 1
    width = F.transform("_safe", lambda x: (F.length(x["r"]) + F.length(x["t"]) + around).cast("long"))
    starts = F.flatten(F.zip_with(_running(F.transform("_runs", lambda x: x["total"]))["before"], "_runs",
                                  lambda at, x: F.transform(x["before"], lambda y: y + at)))
    spans = F.zip_with("_safe", "_starts", lambda x, at: F.struct(
        (at + F.length(x["r"]) + len(START) + len(SEP)).cast("long").alias("start"),
        F.length(x["t"]).cast("long").alias("length"), x["role"].alias("role")))
    loss = F.transform(F.filter("_spans", lambda x: x["role"] == "assistant"),
                       lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return convs.withColumn("_safe", safe).withColumn("_width", width) \
        .withColumn("_runs", F.transform(_stretches(F.col("_width")), _running)) \
        .withColumn("_starts", starts).withColumn("_spans", spans) \
        .withColumn("formatted", F.array_join(rendered, "")).withColumn("loss_spans", loss) \
        .drop("_safe", "_width", "_runs", "_starts", "_spans")


def read_back(out: DataFrame) -> DataFrame:
    """Parse formatted text and loss mask, each span of which lies in one turn:
    add turns_read and loss_text."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda x, i: i > 0)  # the first piece is empty

    def turn(p: Column) -> Column:
        two = F.split(p, r"<\|im_sep\|>")
        return F.struct(unescaped(two[0]).alias("role"),
                        unescaped(F.substring_index(two[1], END, 1)).alias("text"))

    # spans are read from the stretch of turns they lie in: reading from the text's start takes ever longer
    some = F.transform(_stretches(F.col("_parts")), lambda x: F.concat(F.lit(START), F.array_join(x, START)))
    at = _running(F.transform("_some", lambda x: F.length(x).cast("long")))["before"]

    def said(text: Column, at: Column) -> Column:
        inside = F.filter("loss_spans", lambda s: (s["start"] >= at) & (s["start"] < at + F.length(text)))
        return F.array_join(F.transform(inside, lambda s: unescaped(
            F.substring(text, (s["start"] - at + 1).cast("int"), s["length"].cast("int")))), "")

    return out.withColumn("_parts", parts).withColumn("_some", some).withColumn("_at", at) \
        .withColumn("turns_read", F.transform("_parts", turn)) \
        .withColumn("loss_text", F.array_join(F.zip_with("_some", "_at", said), "")).drop("_parts", "_some", "_at")
