"""Sequences over any columns that can be sorted, split by rows, and scans over their chunks.

`numbered` sorts a table over the cluster in ranges and gives each row a place: a whole number that rises with the order, without ties, and by one from
row to row of a range. It is the numeric order that the functions of `sequence` ask for, so running sums, last values and
neighbours work on dates, strings and ties alike, in chunks that hold rows and not values.

`scan` carries a state over the chunks of a part where the next state depends on the one before. What a chunk does to a state must compose; then
chunks are joined in a tree with FAN children a node, up for what runs of chunks do, and down again for the state before each chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import keep

#: Rows of a chunk, as a number of low bits of their places.
BITS = 12
FAN = 64


def numbered(df: DataFrame, part: list[str], order: list[str | Column], name: str = "_place") -> DataFrame:
    """df with a place for each row, up in order of part and then order (nulls first). Rows that the order doesn't tell apart get places in any order."""
    by = [*part, *order]
    return keep(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id()), "places")


def chunk_of(place: str = "_place", bits: int = BITS) -> Column:
    """The chunk of a place: up to 2^bits rows of one range."""
    return F.shiftright(F.col(place), bits)


def scan(chunks: DataFrame, part: str, order: str, effect: str, compose: Callable[[list[bytes]], bytes], state: Callable[[bytes | None, bytes], bytes], backwards: bool = False, fan: int = FAN) -> DataFrame:
    """(part, order, state) for each row of chunks (part, order, effect): the state before it, null for the first of a part.

    compose joins the effects of a run of chunks, first to last, into one; state gives the state behind an effect. Numbers for the tree come from a
    window over one row a chunk.
    """
    kinds = dict(chunks.dtypes)
    p, o = kinds[part], kinds[order]
    rank = F.row_number().over(Window.partitionBy(part).orderBy(F.col(order).desc() if backwards else F.col(order)))
    level = keep(chunks.select(part, order, F.col(effect).alias("effect"), (rank - 1).cast("long").alias("i")), "scan")
    most = level.agg(F.max("i")).first()[0]
    if most is None:
        return chunks.select(part, order, F.lit(None).cast("binary").alias("state"))
    leaves, levels = level, []

    def node(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        return pd.DataFrame({part: rows[part][:1], "effect": [compose(list(rows["effect"]))], "i": [rows["i"].iloc[0] // fan]})

    while most > 0:
        levels.append(level)
        level = keep(level.groupBy(part, F.floor(F.col("i") / fan).alias("up")).applyInPandas(lambda k, r: node(r), f"{part} {p}, effect binary, i long"), "scan")
        most //= fan
    states = level.select(part, "i", F.lit(None).cast("binary").alias("state"))

    def down(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, now, out = rows.sort_values("i"), above["state"].iloc[0], []
        for e in rows["effect"]:
            out.append(now)
            now = state(now, e)
        return pd.DataFrame({part: rows[part], "i": rows["i"], "state": out})

    for level in reversed(levels):
        below = level.withColumn("up", F.floor(F.col("i") / fan)).groupBy(part, "up")
        states = keep(below.cogroup(states.groupBy(part, "i")).applyInPandas(down, f"{part} {p}, i long, state binary"), "scan")
    states = states.withColumnRenamed(part, "_p").withColumnRenamed("i", "_i")
    return leaves.join(states, F.col(part).eqNullSafe(F.col("_p")) & (F.col("i") == F.col("_i"))).select(part, order, "state")
