"""Chat formatting: a dialogue seen from every participant.

For each participant of a conversation the dialogue is rendered with that speaker as the assistant and the others as
named users; a mask lists the code points to learn from: the speaker's own words and the end mark after them. ``system``
turns are instructions for everyone, no participant, and never learned from.

Turns are ordered by number, then speaker, then text. A dialogue is rendered in blocks of ``turns_per_block`` turn numbers,
each a row of its own, so that a conversation that holds a large part of all rows is spread over many groups; one with
fewer turns is a single row. Offsets count from the start of the block.

Nulls and edges: a null speaker is called ``unknown``; a null text is empty; a null turn comes first, in a block of its own
(null); repeated rows are rendered as often as they occur; null conversation ids form one conversation; a conversation of
``system`` turns alone gives no rows. Marks inside a text are broken up by a zero-width space, line ends in a name by a
space, so rendered dialogues can be taken apart again. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


@dataclass(frozen=True)
class ChatSpec:
    turns_per_block: int = 64


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<​|"))


def _name(role: Column) -> Column:
    return F.translate(_safe(F.coalesce(role, F.lit("unknown"))), "\r\n", "  ")


def head(name: Column, speaker: Column) -> Column:
    kind = F.when(name == SYSTEM, F.lit(SYSTEM)).when(name == speaker, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), name))
    return F.concat(F.lit(START), kind, F.lit("\n"))


def rotate(turns: DataFrame, spec: ChatSpec = ChatSpec()) -> DataFrame:
    """``conv_id, speaker, block, n_turns, text, mask`` from ``turns(conv_id, turn, role, text)``; ``mask`` is an array of
    structs (start, end) of code points, ascending."""
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _name(F.col("role")).alias("name"),
        _safe(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )
    rows = rows.withColumn("block", F.floor(F.col("turn") / spec.turns_per_block).cast("long"))
    speakers = rows.where(F.col("name") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("name").alias("speaker")).distinct()
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    said = F.concat("text", F.lit(END))
    parts = F.struct(
        "turn", "name", "text", F.concat(head(F.col("name"), F.col("speaker")), said, F.lit("\n")).alias("all"),
        F.char_length(head(F.col("name"), F.col("speaker"))).alias("skip"), F.char_length(said).alias("length"),
        ((F.col("name") == F.col("speaker")) & (F.col("name") != SYSTEM)).alias("own"),
    )
    grouped = seen.groupBy("conv_id", "speaker", "block").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    span = lambda at, p: F.array(F.struct((at + p["skip"]).alias("start"), (at + p["skip"] + p["length"]).alias("end")))
    empty = F.array().cast("array<struct<start: int, end: int>>")
    walked = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), empty.alias("mask")),
        lambda s, p: F.struct((s["at"] + p["skip"] + p["length"] + 1).alias("at"), F.when(p["own"], F.concat(s["mask"], span(s["at"], p))).otherwise(s["mask"]).alias("mask")),
        lambda s: s["mask"],
    )
    text = F.array_join(F.transform("parts", lambda p: p["all"]), "")
    return grouped.select("conv_id", "speaker", "block", F.size("parts").alias("n_turns"), text.alias("text"), walked.alias("mask"))
