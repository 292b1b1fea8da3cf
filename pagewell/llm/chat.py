"""Chat formatting by perspective rotation.

Every participant of a dialogue gets a rendering of it in which they are the
assistant and all others are named users. System turns stay system turns; they
have no rendering of their own. A dialogue is rendered in segments of turn
numbers, so that one with very many turns is spread over tasks; most have one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_TURNS = 64
SYSTEM = "system"
UNNAMED = "unknown"

# --- fixed values: the marks of the format ------------------------------------
OPEN, CLOSE, END, LINE = "<|", "|>", "<|end|>", "\n"


def _defused(text: Column) -> Column:
    """Text that can't be taken for a mark of the format."""
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def _header(role: Column, speaker: Column) -> Column:
    name = F.replace(F.replace(role, F.lit('"'), F.lit("'")), F.lit(OPEN), F.lit("< |"))
    return (
        F.when(role == SYSTEM, F.lit(f"{OPEN}system{CLOSE}{LINE}"))
        .when(role == speaker, F.lit(f"{OPEN}assistant{CLOSE}{LINE}"))
        .otherwise(F.concat(F.lit(f'{OPEN}user name="'), name, F.lit(f'"{CLOSE}{LINE}')))
    )


def rotate_perspectives(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """``conv_id, speaker, segment, n_turns, text, mask``: one row per dialogue,
    participant and segment; the segments in order are the whole dialogue.

    ``mask`` lists ``(start, end)`` in characters of ``text``: the speaker's own
    turns with their end marks, which a model trained on the row learns to write.

    Turns are ordered by number, then role, then text; a null number comes
    first, in a segment of its own (null). A row repeated exactly is one turn. A
    null role is the participant "unknown"; a null text is an empty turn. A
    dialogue of system turns alone, or an empty table, gives no rows. A
    participant who says nothing in a segment has it with an empty mask. Other
    columns are not read.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(UNNAMED)).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    segments = said.groupBy("conv_id", F.floor(F.col("turn") / segment_turns).alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    speakers = turns.select("conv_id", F.coalesce("role", F.lit(UNNAMED)).alias("speaker")).where(
        F.col("speaker") != SYSTEM
    ).distinct().withColumnRenamed("conv_id", "_conv")
    each = segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
    pieces = F.transform("turns", lambda t: F.struct(
        _header(t["role"], F.col("speaker")).alias("head"),
        F.concat(_defused(t["text"]), F.lit(END)).alias("body"),
        (t["role"] == F.col("speaker")).alias("own"),
    ))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    walked = F.aggregate("pieces", start, lambda a, p: F.struct(
        (a["at"] + F.length(p["head"]) + F.length(p["body"]) + len(LINE)).alias("at"),
        F.when(p["own"], F.concat(a["mask"], F.array(F.struct(
            (a["at"] + F.length(p["head"])).alias("start"), (a["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end"),
        )))).otherwise(a["mask"]).alias("mask"),
    ))
    return each.select("conv_id", "speaker", "segment", F.size("turns").alias("n_turns"), pieces.alias("pieces")).select(
        "conv_id", "speaker", "segment", "n_turns",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(LINE))), "").alias("text"),
        walked["mask"].alias("mask"),
    )


def chat_report(turns: DataFrame) -> DataFrame:
    """The renderings with the mask as text, ``start-end`` by commas."""
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rotate_perspectives(turns).withColumn("mask", F.array_join(spans, ","))
