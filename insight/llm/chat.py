"""Chat formatting: a role machine and a declarative template, all in DataFrame functions.

The machine's state is the role last seen; ``MOVES`` lists the roles that may
follow each state and ``FINAL`` the roles a conversation may end on. Each turn
becomes a list of segments ``(text, loss)`` from the template: literal parts
never carry loss, the text part carries it for the template's loss roles.

Control strings start with ``<|``. Inside roles and texts, every ``<``, run of
backslashes, ``|`` gets one backslash more, so no control string can appear
there and ``unescape`` takes exactly that backslash away again. Line feeds in
roles become the control string ``<|nl|>``, so the first line feed of a turn
always ends its role.

Defined cases: null roles and texts are empty; null ids form a conversation
of their own; turns go by turn number (null first), then role, then text, so
ties and repeated rows have one order; invalid turn orders are formatted too
and told in ``valid``. An empty table gives no rows. Only the four named
columns are read. One conversation's digest needs its text in one row, so a
conversation must fit into one value (Spark's limit: 2 GB); the segments
themselves (``segments``) are one row per part and need no such group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts of a turn: a literal, or the role or the text between literals.
TEMPLATE = {
    "parts": ("<|im_start|>", "{role}", "\n", "{text}", "<|im_end|>\n"),
    "loss_roles": ("assistant",),
}
#: State -> roles that may follow; "" is the start.
MOVES = {
    "": ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}
FINAL = ("assistant",)


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def may_follow(state: Column, role: Column) -> Column:
    """Whether the machine accepts ``role`` in ``state``."""
    ok = F.lit(False)
    for s, nexts in MOVES.items():
        ok = ok | ((state == s) & role.isin(*nexts))
    return ok


def part_segments(role: Column, text: Column, template: dict = TEMPLATE) -> Column:
    """The segments of one turn: array of (text, loss)."""
    learns = role.isin(*template["loss_roles"])
    out = []
    for part in template["parts"]:
        if part == "{role}":
            out.append(F.struct(F.replace(escape(role), F.lit("\n"), F.lit("<|nl|>")).alias("text"), F.lit(False).alias("loss")))
        elif part == "{text}":
            out.append(F.struct(escape(text).alias("text"), learns.alias("loss")))
        else:
            out.append(F.struct(F.lit(part).alias("text"), F.lit(False).alias("loss")))
    return F.array(*out)


def clean_turns(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def segments(rows: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per segment: conv_id, turn, part, text, loss, legal (this turn may follow the last)."""
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = clean_turns(rows).withColumn("state", F.coalesce(F.lag("role").over(order), F.lit("")))
    turns = turns.withColumn("legal", may_follow(F.col("state"), F.col("role")))
    return (turns.select("conv_id", "turn", "legal", F.posexplode(part_segments(F.col("role"), F.col("text"), template)).alias("part", "seg"))
            .select("conv_id", "turn", "legal", "part", F.col("seg.text").alias("text"), F.col("seg.loss").alias("loss")))


def conversations(rows: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, segments (array of text and loss), formatted, valid."""
    turns = clean_turns(rows).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(
            F.coalesce(F.col("turn"), F.lit(-(1 << 63))).alias("turn"), "role", "text"))).alias("turns"))
    steps = F.aggregate(
        "turns", F.struct(F.lit("").alias("state"), F.lit(True).alias("ok")),
        lambda acc, t: F.struct(t["role"].alias("state"), (acc["ok"] & may_follow(acc["state"], t["role"])).alias("ok")))
    made = turns.select(
        "conv_id", F.flatten(F.transform("turns", lambda t: part_segments(t["role"], t["text"], template))).alias("segments"),
        steps.alias("end"))
    return made.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("end.ok") & F.col("end.state").isin(*FINAL)).alias("valid"))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns that a formatted string holds, for the default template."""
    chunks = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)
    def turn(chunk: Column) -> Column:
        at = F.locate("\n", chunk)
        body = F.substr(chunk, at + 1, F.length(chunk) - at - F.lit(len("<|im_end|>\n")))
        role = F.substr(chunk, F.lit(1), at - 1)
        return F.struct(unescape(F.replace(role, F.lit("<|nl|>"), F.lit("\n"))).alias("role"), unescape(body).alias("text"))
    return F.transform(chunks, turn)


def loss_text(segs: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segs, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
