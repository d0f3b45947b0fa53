"""Operator 8: chat formatting from event logs, with DataFrame functions alone.

An event is (conv_id, seq, turn, kind, role, text). Kinds: ``message`` opens a message of that turn with
a text, ``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` drops its text so that later
deltas start anew. Events are brought together by conversation and turn, put in order of sequence, and
folded into final messages; these are rendered one by one and only then joined, in two steps, to
conversations, so that the work on one hot conversation is spread over its turns.

Template: a turn is ``<|role|>``, a line feed, its text, ``<|end|>`` and a line feed. In texts and roles
``~ < [`` are written ``~0 ~1 ~2`` (in roles also ``|`` as ``~3``), so no control string of this or of
other templates can stand in a text; the way back is unique.

The loss mask has an entry per turn: `skip` characters without loss from the turn's start, then `loss`
characters under it (an assistant's whole text), then the rest without.

Defined results: a null text is empty, a null role is an empty role, a null kind is a message, a null
turn sorts first; messages of one turn follow their sequence, then role and text; an empty table gives no
conversations; events of a turn that has no message yet open an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm._common import materialise

#: Characters written as an escape in texts, in the order in which they are replaced.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
ROLE_ESCAPES = (*ESCAPES, ("|", "~3"))
END = "<|end|>\n"


def escape(column: Column, pairs=ESCAPES) -> Column:
    for plain, written in pairs:
        column = F.replace(column, F.lit(plain), F.lit(written))
    return column


def unescape(column: Column, pairs=ESCAPES) -> Column:
    for plain, written in reversed(pairs):
        column = F.replace(column, F.lit(written), F.lit(plain))
    return column


def fold_events(events: DataFrame, span: int = 1024) -> DataFrame:
    """Final messages: conv_id, span, turn, part (number of the message in its turn), role, text.

    Events are dealt by conversation and run of `span` turns, once: folding by turn and joining the turns of
    a run need no other shuffle.
    """
    rows = events.select(
        "conv_id",
        "turn",
        F.col("seq"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / span).alias("span"),
    ).repartition("conv_id", "span")
    order = Window.partitionBy("conv_id", "span", "turn").orderBy("seq", "role", "text")
    rows = rows.withColumn("part", F.sum(F.when(F.col("kind") == "message", 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("at", F.row_number().over(order))
    found = rows.groupBy("conv_id", "span", "turn", "part").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "role", "text"))).alias("log"))
    # the text is what follows the last event that sets it anew
    last = F.aggregate("log", F.lit(0), lambda n, e: F.when(e.kind != "delta", e["at"]).otherwise(n))
    kept = F.filter("log", lambda e: (e["at"] >= last) & (e.kind != "regenerate"))
    return found.select("conv_id", "span", "turn", "part", F.col("log")[0].role.alias("role"), F.array_join(F.transform(kept, lambda e: e.text), "").alias("text"))


def format_chat(events: DataFrame, loss_role: str = "assistant", span: int = 1024) -> DataFrame:
    """One row per conversation: conv_id, formatted, mask (array of skip, loss by turn).

    span: turns joined in the first of the two steps.
    """
    m = fold_events(events, span)
    head = F.concat(F.lit("<|"), escape(F.col("role"), ROLE_ESCAPES), F.lit("|>\n"))
    body = escape(F.col("text"))
    turn = m.select(
        "conv_id",
        "span",
        "turn",
        "part",
        F.concat(head, body, F.lit(END)).alias("text"),
        F.struct(F.length(head).cast("long").alias("skip"), F.when(F.col("role") == loss_role, F.length(body)).otherwise(0).cast("long").alias("loss")).alias("mask"),
    )
    first = turn.groupBy("conv_id", "span").agg(F.sort_array(F.collect_list(F.struct("turn", "part", "text", "mask"))).alias("t"))
    first = first.select("conv_id", "span", F.array_join(F.transform("t", lambda x: x.text), "").alias("text"), F.transform("t", lambda x: x["mask"]).alias("mask"))
    whole = first.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("span", "text", "mask"))).alias("t"))
    return whole.select("conv_id", F.array_join(F.transform("t", lambda x: x.text), "").alias("formatted"), F.flatten(F.transform("t", lambda x: x["mask"])).alias("mask"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """Back to turns, from the formatted text and the mask alone: conv_id, formatted, turns (array of role, text), under (text under the mask, unescaped)."""
    pieces = F.split("formatted", r"<\|end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, 3, 2147483647), "|>\n", 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(p, F.length(F.substring_index(p, "|>\n", 1)) + 4, F.length(p))).alias("text"),
        ),
    )
    under = F.transform(F.arrays_zip(pieces.alias("p"), F.col("mask").alias("m")), lambda x: F.substring(x["p"], (x["m"]["skip"] + 1).cast("int"), x["m"]["loss"].cast("int")))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), unescape(F.array_join(under, "")).alias("under"))


def write_chat(events: DataFrame) -> DataFrame:
    """Format, write to the shared folder, and read back."""
    return materialise(format_chat(events), "chat")
