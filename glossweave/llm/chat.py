"""Chat formatting by multi-party perspective rotation.

For every participant the whole dialogue is rendered once with that speaker as assistant, the others as named users, and system turns as they
are; the mask covers what the speaker says. All in DataFrame functions. Dialogues are written in parts of PART turn numbers, so that a
long one with numbered turns is never gathered into one row; parts follow each other by number, and start tells where a part's text begins in the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"


def rotate(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", part: int = PART) -> DataFrame:
    """(conv_id, speaker, part, start, text, mask array<struct<start, end>>), one row for each participant and part of a dialogue.

    Turns are ordered by number, speaker and text, null numbers last, in a part of their own, which is as long as they are many, as is
    a part whose numbers are repeated; a null speaker is called unknown, a null text is
    empty, repeated rows are repeated turns, a null conversation is a conversation of its own, and one of system turns only has no participant and gives no
    row. Marks of the format inside texts are broken up. Mask spans are code points of the part's text, end exclusive.
    """
    clean = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"<\|", "< |")
    who = F.regexp_replace(F.coalesce(F.col(speaker_col).cast("string"), F.lit(UNKNOWN)), r"<\|", "< |")
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.floor(F.col(turn_col) / part).cast("long").alias("part"),
        F.struct(F.coalesce(F.col(turn_col).cast("long"), F.lit((1 << 63) - 1)).alias("turn"), who.alias("who"), clean.alias("body")).alias("t"),
    )
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    speakers = rows.where(F.col("t.who") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("t.who").alias("speaker")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    # Head, body and tail of every turn from the speaker's side.
    head = "case when t.who = speaker then 'assistant' when t.who = 'system' then 'system' else concat('user name=', t.who) end"
    segments = F.expr(f"transform(turns, t -> struct(concat('{OPEN}', {head}, '\\n') as head, t.body as body, t.who = speaker as mine))")
    both = both.withColumn("segments", segments)
    tail = len(CLOSE)
    text = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit(CLOSE))), "")
    folded = F.expr(
        f"""aggregate(segments, cast(struct(0 as at, array() as spans) as struct<at: bigint, spans: array<struct<start: bigint, end: bigint>>>),
        (acc, s) -> struct(acc.at + length(s.head) + length(s.body) + {tail} as at,
            if(s.mine, array_append(acc.spans, struct(acc.at + length(s.head) as start, acc.at + length(s.head) + length(s.body) + {tail - 1} as end)), acc.spans) as spans))"""
    )
    out = both.select("conv_id", "speaker", "part", text.alias("text"), folded["spans"].alias("mask"))
    before = Window.partitionBy("conv_id", "speaker").orderBy(F.col("part").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("long")).over(before), F.lit(0).cast("long"))
    return out.withColumn("start", start).select("conv_id", "speaker", "part", "start", "text", "mask")
