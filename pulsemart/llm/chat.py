"""Chat formatting by perspective rotation.

For every speaker of a conversation the dialogue is rendered with that
speaker as the assistant and the others as named users; the mask covers the
speaker's own turns (text and end marker), on which a model would be trained.
Context roles (``system``) are rendered as they are and never rotated to.

A conversation is cut into parts of at most ``PART_TURNS`` turns, by a turn's place in
it, whatever the turn numbers are; each later part repeats the context turns of the
first one, so it can stand alone.  Places come from a range partitioning, so no
task holds a long conversation.  A usual conversation is one part.

Defined cases: a null role or an empty one is the speaker ``unknown``; a null text is an
empty turn; null turn numbers come after the others, ordered by role and text; a
null conversation id is a conversation; a repeated row (same conversation,
turn, role and text) is one turn, and different rows of one turn number are
ordered by role and text; a conversation of context turns alone has no
perspective and gives no row; markers inside a text are defused; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.places import placed
from pulsemart.llm.scratch import Scratch

PART_TURNS = 256
CONTEXT_ROLES = ("system",)
START, END = "<|im_start|>", "<|im_end|>"
DEFUSED = "<\u200b|"                # a zero-width space keeps "<|" in a text from being read as a marker


def _header(turn: Column, speaker: Column, context: Sequence[str]) -> Column:
    role = F.when(turn["role"] == speaker, F.lit("assistant")).when(
        turn["role"].isin(*context), turn["role"]
    ).otherwise(F.concat(F.lit("user name="), F.replace(turn["role"], F.lit("<|"), F.lit(DEFUSED))))
    return F.concat(F.lit(START), role, F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit(DEFUSED)), F.lit(END))


def _rendered(turns: Column, speaker: Column, context: Sequence[str]) -> Column:
    return F.array_join(F.transform(
        turns, lambda t: F.concat(_header(t, speaker, context), _body(t), F.lit("\n"))), "")


def _mask(turns: Column, speaker: Column, context: Sequence[str]) -> Column:
    """(start, length) in characters of the speaker's turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        head, body = F.char_length(_header(t, speaker, context)), F.char_length(_body(t))
        own = F.array(F.struct((acc["at"] + head).alias("start"), body.alias("length")))
        return F.struct(
            (acc["at"] + head + body + 1).alias("at"),
            F.when(t["role"] == speaker, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def rotate_perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", context: Sequence[str] = CONTEXT_ROLES, part_turns: int = PART_TURNS,
) -> DataFrame:
    """A row per conversation, speaker and ``part``: ``n_turns`` (of the part itself),
    ``n_context`` (turns repeated at its head), ``rendered`` and ``mask``."""
    scratch = Scratch(turns.sparkSession, "chat")
    role = F.when(F.coalesce(F.col(role_col), F.lit("")) == "", F.lit("unknown")).otherwise(F.col(role_col))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("-")).alias("grp"),
        F.col(turn_col).isNull().alias("late"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    ).distinct()
    numbered = placed(rows, scratch, "turns", "late", "turn", "role", "text")
    parts = scratch.store(numbered.groupBy("conv", F.floor(F.col("pos") / part_turns).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("turns")), "parts")
    scratch.drop("turns_ranged")
    each = parts.select("conv", F.explode("turns.role").alias("speaker")).filter(~F.col("speaker").isin(*context))
    speakers = scratch.store(each.distinct().withColumnRenamed("conv", "c"), "speakers")
    nothing = F.array().cast(parts.schema["turns"].dataType)
    first = parts.filter("part = 0").select(
        F.col("conv").alias("c0"), F.filter("turns", lambda t: t["role"].isin(*context)).alias("context"))
    later = parts.filter("part > 0").join(first, F.col("conv").eqNullSafe(F.col("c0"))).drop("c0")       # long conversations only
    whole = parts.filter("part = 0").withColumn("context", nothing).unionByName(later)
    seen = whole.join(speakers, F.col("conv").eqNullSafe(F.col("c"))).withColumn("all", F.concat("context", "turns"))
    return seen.select(
        F.col("conv").alias(conv_col), "speaker", "part", F.size("turns").alias("n_turns"), F.size("context").alias("n_context"),
        _rendered(F.col("all"), F.col("speaker"), context).alias("rendered"),
        _mask(F.col("all"), F.col("speaker"), context).alias("mask"),
    )
