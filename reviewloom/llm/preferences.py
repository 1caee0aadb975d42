"""Preference formatting of chosen and rejected conversations. DataFrame functions only.

A pair is two lists of turns. Their longest common prefix of equal turns (role and text) is
rendered once, as the prompt; what follows in each is its completion. Completions carry a mask: the
spans, in characters of the completion, that are learned from, which are the bodies of assistant
turns with the line end that closes them. The prompt is never learned from.

Defined cases: a null role is "unknown", a null text is empty; turns are ordered by number, then
role, then text, and repeated rows stay; of equal lists all is prompt and both completions are
empty; a missing list is an empty one. Turns of one conversation meet in one row, as its rendering
is one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import let

TRAINED_ROLE = "assistant"
_TURNS = "array<struct<role:string,text:string>>"


def turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("unknown")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _head(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    """<|role|>, a line end, the text, a line end, for each turn."""
    return F.array_join(F.transform(turns, lambda x: F.concat(_head(x), x["text"], F.lit("\n"))), "")


def mask(turns: Column) -> Column:
    """start:end of the trained spans of the rendered turns, joined by commas."""

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(_head(x)).cast("long")
        end = start + F.length(x["text"]).cast("long") + 1
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        spans = F.when(x["role"] == TRAINED_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda state: F.array_join(state["spans"], ","))


def common_prefix(a: Column, b: Column) -> Column:
    """The number of leading turns that are equal."""
    shorter = F.least(F.size(a), F.size(b))
    differs = F.zip_with(F.slice(a, 1, shorter), F.slice(b, 1, shorter), lambda x, y: x != y)
    at = F.array_position(differs, F.lit(True))
    return F.when(at > 0, at - 1).otherwise(shorter).cast("int")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected), the latter arrays of (role, text), to one row per pair:

    pair_id, n_prompt (turns), prompt, chosen, rejected (completions), chosen_mask, rejected_mask.
    """
    empty = F.array().cast(_TURNS)
    lists = pairs.select("pair_id", F.coalesce("chosen", empty).alias("c"), F.coalesce("rejected", empty).alias("r"))
    cut = lists.select("pair_id", "c", "r", let(F.struct("c", "r"), lambda x: common_prefix(x["c"], x["r"])).alias("n"))
    rest = lambda name: F.slice(name, F.col("n") + 1, F.greatest(F.size(name) - F.col("n"), F.lit(0)))
    parts = cut.select("pair_id", "n", F.slice("c", 1, F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return parts.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt"), render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        mask(F.col("c")).alias("chosen_mask"), mask(F.col("r")).alias("rejected_mask"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations (conv_id, turn, role, text): each is chosen once.

    Conversations 2k and 2k + 1 are neighbours. The rejected list is the chosen one with its last
    assistant turn, and what follows it, replaced by the last assistant turn of the neighbour (left
    out if there is none). Without an assistant turn, the neighbour's is added at the end. Rows
    without conv_id are no conversation. Ids must be integers, of any size; others are refused.
    """
    if not isinstance(conversations.schema["conv_id"].dataType, IntegralType):
        raise ValueError("conv_id must be an integer")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.shiftright("conv_id", 1).alias("two"), F.pmod("conv_id", F.lit(2)).alias("odd"), "conv_id", "turn",
        turn(F.col("role"), F.col("text")).alias("x"),
    )
    both = rows.groupBy("two").agg(F.array_sort(F.collect_list(F.struct("odd", "turn", "x", "conv_id"))).alias("all"))
    own = lambda k: F.filter("all", lambda t: t["odd"] == k)
    lists = both.select(own(0).alias("even"), own(1).alias("odd"))
    sides = F.array(F.struct(F.col("even").alias("own"), F.col("odd").alias("other")), F.struct(F.col("odd").alias("own"), F.col("even").alias("other")))
    each = lists.select(F.explode(sides).alias("s")).where(F.size("s.own") > 0)
    turns = each.select(
        F.element_at("s.own", 1)["conv_id"].alias("pair_id"),
        F.transform("s.own", lambda t: t["x"]).alias("chosen"),
        F.transform(F.filter("s.other", lambda t: t["x"]["role"] == TRAINED_ROLE), lambda t: t["x"]).alias("replies"),
    )
    last = F.array_position(F.reverse(F.transform("chosen", lambda x: x["role"] == TRAINED_ROLE)), F.lit(True))
    kept = F.when(last > 0, F.size("chosen") - last).otherwise(F.size("chosen")).cast("int")
    return turns.select(
        "pair_id", "chosen",
        F.concat(F.slice("chosen", F.lit(1), kept), F.slice("replies", F.greatest(F.size("replies"), F.lit(1)), F.lit(1))).alias("rejected"),
    )
