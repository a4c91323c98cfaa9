"""Chat formatting: every participant's view of a dialogue, with that speaker as the assistant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.session import materialise

#: This many turns after each other are rendered together; longer dialogues come in several parts.
PART_TURNS = 512
END = "<|end|>\n"


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``place``: the number of the dialogue's rows before this one by turn, role and text."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    dealt = materialise(dealt.withColumn("range", F.shiftright("id", 33)), "turns")
    runs = dealt.groupBy("conv_id", "range").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv_id").alias("c"), F.col("range").alias("r"),
                       (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    found = dealt.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
    return found.select("conv_id", "turn", "role", "text", (F.col("id") + F.col("shift")).alias("place"))


def rotate_perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", *, system: str = "system", part_turns: int = PART_TURNS) -> DataFrame:
    """One row per (dialogue, participant, part): ``conv_id, speaker, part, n_turns, rendered, masks``.

    Every role but ``system`` is a participant.  In its view its own turns are the assistant's, all others are named
    users' turns and system turns stay system.  ``masks`` holds the spans to learn from (``start, end`` in code
    points of ``rendered``, end exclusive): the assistant's texts with their end mark.

    A null role is a participant named ``unknown``; a null text is an empty turn; null turn numbers come first; turns
    with equal numbers are ordered by role and text; every row is a turn, repeated ones too; ``<|`` inside a text
    becomes ``< |`` so that no text can forge a mark.  A dialogue without participants (system only) has no row.  Null
    dialogue ids form one dialogue.

    Part ``n`` holds the ``part_turns`` turns from place ``n * part_turns`` of the dialogue on, whatever their numbers, so
    a dialogue with most of the rows is rendered by many tasks, and participants are joined to parts instead of being
    gathered.  Places follow from a sort by range and the numbers of rows before each range.  The output is turns times
    participants by nature.
    """
    clean = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), F.lit("<\\|"), F.lit("< |"))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("unknown")).alias("role"), clean.alias("text"))
    rows = _placed(rows)
    part = F.floor(F.col("place") / part_turns).cast("long").alias("part")
    parts = rows.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    speakers = rows.where(F.col("role") != system).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")
                                                          ).distinct()
    views = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    pieces = F.transform("turns", lambda t: F.struct(
        F.when(t.role == F.col("speaker"), F.lit("<|assistant|>\n")).when(t.role == system, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), t.role, F.lit("|>\n"))).alias("head"),
        F.concat(t.text, F.lit(END)).alias("body"), (t.role == F.col("speaker")).alias("own")))
    views = views.withColumn("pieces", pieces)
    spans = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))

    def add(state, p):
        start = state.at + F.length(p.head)
        end = start + F.length(p.body)
        mine = F.when(p.own, F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast(spans))
        return F.struct(end.alias("at"), F.concat(state.out, mine).alias("out"))

    rendered = F.array_join(F.transform("pieces", lambda p: F.concat(p.head, p.body)), "")
    return views.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"),
                        rendered.alias("rendered"), F.aggregate("pieces", zero, add).out.alias("masks"))
