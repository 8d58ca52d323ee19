"""Exact quantiles of groups of any size: cells of values first, ranks within the one cell that matters after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096


def exact(df: DataFrame, part: list[str], value: str, shares: dict[str, float], cells: int = CELLS) -> DataFrame:
    """(part…, a column for each share): the continuous quantiles of value, nulls left out. A group without values has no row.

    A quantile lies between the values at two ranks. A group's values are counted by cells between its smallest and largest value; the cells that hold
    those ranks are counted value by value, and only there are ranks looked up. Equal values are one row, so a pile of them is no load.
    """
    rows = df.where(F.col(value).isNotNull()).select(*(F.col(p).alias(f"_p{i}") for i, p in enumerate(part)), F.col(value).cast("double").alias("_x"))
    keys = [f"_p{i}" for i in range(len(part))]
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    ends = rows.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count("*").alias("_n"))
    cell = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * cells)).otherwise(F.lit(0)).cast("long")
    marked = rows.alias("r").join(ends.alias("e"), same("r", "e")).select(*(f"r.{k}" for k in keys), "_x", "_n", cell.alias("_cell"))
    counts = marked.groupBy(*keys, "_cell", "_n").agg(F.count("*").alias("_m"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_from", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    ranks = F.array(*(F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("_n") - 1)).alias("at")) for name, q in shares.items()))
    wanted = counts.select("*", F.explode(ranks).alias("_q"))
    holds = lambda r: (F.col("_from") <= r) & (r < F.col("_from") + F.col("_m"))
    low, high = F.floor("_q.at"), F.ceil("_q.at")
    wanted = wanted.where(holds(low) | holds(high))
    cellwise = wanted.select(*keys, "_cell", "_from").distinct()
    on = [*same("c", "m"), F.col("c._cell") == F.col("m._cell")]
    few = marked.alias("m").join(cellwise.alias("c"), on).select(*(f"m.{k}" for k in keys), "m._cell", "c._from", "_x")
    few = few.groupBy(*keys, "_cell", "_from", "_x").agg(F.count("*").alias("_k"))
    inner = Window.partitionBy(*keys, "_cell").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    few = few.withColumn("_first", F.col("_from") + F.coalesce(F.sum("_k").over(inner), F.lit(0)))
    asked = wanted.select(*keys, F.col("_q.name").alias("_name"), F.col("_q.at").alias("_at")).distinct()
    met = few.alias("f").join(asked.alias("a"), same("f", "a"))
    at = lambda r: F.max(F.when((F.col("_first") <= r) & (r < F.col("_first") + F.col("_k")), F.col("_x")))
    found = met.groupBy(*(F.col(f"f.{k}").alias(k) for k in keys), "_name", "_at").agg(at(F.floor("_at")).alias("_l"), at(F.ceil("_at")).alias("_h"))
    found = found.withColumn("_v", F.col("_l") + (F.col("_h") - F.col("_l")) * (F.col("_at") - F.floor("_at")))
    return found.groupBy(*(F.col(k).alias(p) for k, p in zip(keys, part))).agg(*(F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in shares))
