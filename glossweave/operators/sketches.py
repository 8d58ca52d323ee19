"""Sketches that are kept by period and merged into longer ones: distinct counts and quantiles without the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the buckets of a count's sketch, and entries of a set's.
LOG_K, THETA_LOG_K = 12, 14


def daily(df: DataFrame, day: Column, item: str, value: str) -> DataFrame:
    """(day, n, items, members, values): the number of rows, and sketches of distinct items (for counts, and for sets to be combined) and of the values."""
    return df.groupBy(day.alias("day")).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(item, LOG_K).alias("items"), F.theta_sketch_agg(item, THETA_LOG_K).alias("members"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("values"))


def merged(days: DataFrame, period: Column) -> DataFrame:
    """(period, n, items, members, values): the days' sketches as one a period."""
    return days.groupBy(period.alias("period")).agg(F.sum("n").alias("n"), F.hll_union_agg("items").alias("items"), F.theta_union_agg("members").alias("members"), F.kll_merge_agg_double("values").alias("values"))


def read(periods: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """(period, n, distinct, members, q50, …): what the sketches say."""
    named = [F.kll_sketch_get_quantile_double("values", F.lit(q)).alias(f"q{round(100 * q)}") for q in quantiles]
    return periods.select("period", "n", F.hll_sketch_estimate("items").alias("distinct"), F.theta_sketch_estimate("members").alias("members"), *named)


def shared(periods: DataFrame, other: DataFrame) -> DataFrame:
    """(period, shared): how many members two periods' sketches have in common, by period."""
    o = other.select("period", F.col("members").alias("_o"))
    return periods.join(o, "period").select("period", F.theta_sketch_estimate(F.theta_intersection("members", "_o")).alias("shared"))
