"""Multi-party perspective rotation: each dialogue once per participant, with that speaker as the assistant."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import rank_within
from ..operators.skew import GROUP_ROWS
from .common import attach_lists, c, materialize

PART_TURNS = 256
#: Parts of a conversation whose list of participants is repeated at most once, when the lists are too large to broadcast.
SLICE_PARTS = 1000
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _head(speaker: Column, perspective: Column, instructions: Column) -> Column:
    """What opens a turn: system turns as such, the perspective's own as the assistant's, others by name."""
    who = F.when(instructions, F.lit("system")).when(speaker == perspective, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), speaker))
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    instructions: Sequence[str] = ("system",),
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """One row per conversation, participant and part: ``conv_id, part, perspective, n_turns, rendered, mask``.

    Every speaker but those in ``instructions`` is a participant. ``rendered`` holds the turns in order; the turns of
    the row's participant are the assistant's, the others' are users' with their names, and ``mask`` lists the
    [start, end) character spans of the assistant's texts, each with its closing mark, where the loss applies.

    A conversation is rendered in parts of ``part_turns`` consecutive turn numbers, so a row and a task never hold
    an unbounded dialogue; a part has a row for the participants that speak in it. Turns without a
    number come first. Turns of equal number are ordered by speaker and text; repeated rows are turns of their own.
    A null speaker is named ``unknown``, a null text is empty; null conversation ids form one conversation. A dialogue
    of instructions only gives no row. Parts of a conversation that has a turn number repeated without bound are as
    long as that repetition. ``rotate_whole`` has neither of these limits.
    """
    named = turns.select(
        c(conversation).alias("conv"),
        F.coalesce(F.floor(c(turn) / part_turns), F.lit(0)).cast("long").alias("part"),
        F.struct(
            c(turn).alias("turn"),
            F.coalesce(c(speaker).cast("string"), F.lit("unknown")).alias("speaker"),
            F.coalesce(c(text), F.lit("")).alias("text"),
        ).alias("line"),
    )
    parts = named.groupBy("conv", "part").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    is_instruction = lambda s: s.isin(*instructions) if instructions else F.lit(False)
    speakers = F.array_distinct(F.transform("lines", lambda x: x["speaker"]))
    each = parts.withColumn("perspective", F.explode(F.filter(speakers, lambda s: ~is_instruction(s))))
    return _render(each, conversation, is_instruction)


def rotate_whole(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    instructions: Sequence[str] = ("system",),
    part_rows: int = PART_TURNS,
    group_rows: int = GROUP_ROWS,
    slice_parts: int = SLICE_PARTS,
) -> DataFrame:
    """``rotate`` with parts cut every ``part_rows`` turns by their place in the conversation, whatever the numbers are.

    Every participant of the conversation has a row for every part, so their rows together hold the whole dialogue; the
    mask of a part they are silent in is empty. A later part opens with the instructions given before it, each distinct
    one once and in order of its first place; ``n_turns`` counts them. Turns are ordered as in ``rotate``, those without
    a number first, and any number of them is split. Conversations above ``group_rows`` turns are ordered over many tasks.
    """
    is_instruction = lambda s: s.isin(*instructions) if instructions else F.lit(False)
    named = turns.select(
        F.when(c(conversation).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c(conversation).cast("string"))).alias("key"),
        c(conversation).alias("conv"),
        c(turn).alias("turn"),
        F.coalesce(c(speaker).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(c(text), F.lit("")).alias("text"),
    )
    placed = rank_within(named, ["key"], [F.col("turn"), F.col("speaker"), F.col("text")], "place", group_rows)
    line = F.struct("place", "speaker", "text")
    parts = placed.groupBy("key", F.floor((F.col("place") - 1) / part_rows).cast("long").alias("part")).agg(
        F.first("conv").alias("conv"), F.array_sort(F.collect_list(line)).alias("lines")
    )
    parts = materialize(parts, "parts")
    own = F.array_distinct(F.transform("lines", lambda x: x["speaker"]))
    # A conversation of one part has all it needs; only the longer ones get lists.
    longer = parts.groupBy("key").agg((F.max("part") + 1).alias("n_parts")).where("n_parts > 1")
    said = F.transform("lines", lambda x: F.struct(x["speaker"].alias("speaker"), F.when(is_instruction(x["speaker"]), x["text"]).alias("text"), x["place"].alias("place")))
    # Parts of longer conversations are later ones or full, so few others are shuffled.
    each = parts.where((F.col("part") > 0) | (F.size("lines") >= part_rows)).select("key", F.explode(said).alias("x"))
    each = each.join(longer, "key", "left_semi")
    each = each.groupBy("key", "x.speaker", "x.text").agg(F.min("x.place").alias("place"))
    ordered = lambda own, *names: F.array_sort(F.collect_list(F.when(own, F.struct(*names))))
    lists = each.groupBy("key").agg(
        F.collect_list(F.when(~is_instruction(F.col("speaker")), F.col("speaker"))).alias("people"),
        ordered(is_instruction(F.col("speaker")), "place", "speaker", "text").alias("orders"),
        F.sum(1 + F.length("speaker") + F.coalesce(F.length("text"), F.lit(0))).alias("chars"),
    )
    lists = lists.join(longer, "key")
    rows = attach_lists(parts, lists, "key", F.ceil(F.col("chars") / 16), [F.col("part")], slice_parts, "n_parts")
    carried = F.filter("orders", lambda x: x["place"] <= F.col("part") * part_rows)
    rows = rows.select(
        "conv",
        "part",
        F.when(F.col("orders").isNull(), F.col("lines")).otherwise(F.concat(carried, "lines")).alias("lines"),
        F.explode(F.coalesce("people", F.filter(own, lambda s: ~is_instruction(s)))).alias("perspective"),
    )
    return _render(rows, conversation, is_instruction)


def _render(each: DataFrame, conversation: str, is_instruction: Callable[[Column], Column]) -> DataFrame:
    """The output of ``rotate`` from rows of ``conv``, ``part``, ``lines`` and ``perspective``."""
    p = F.col("perspective")
    heads = F.transform("lines", lambda x: _head(x["speaker"], p, is_instruction(x["speaker"])))
    each = each.withColumn("heads", heads)
    sizes = F.zip_with("lines", "heads", lambda x, h: F.struct(F.length(h).alias("h"), (F.length(x["text"]) + len(CLOSE)).alias("b"), ((x["speaker"] == p) & ~is_instruction(x["speaker"])).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        body = state["at"] + x["h"]
        span = F.array(F.struct(body.alias("start"), (body + x["b"]).alias("end")))
        return F.struct((body + x["b"]).alias("at"), F.when(x["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return each.select(
        F.col("conv").alias(conversation),
        "part",
        "perspective",
        F.size("lines").cast("long").alias("n_turns"),
        F.array_join(F.zip_with("lines", "heads", lambda x, h: F.concat(h, x["text"], F.lit(CLOSE))), "").alias("rendered"),
        F.aggregate(sizes, start, step, lambda s: s["spans"]).alias("mask"),
    )

