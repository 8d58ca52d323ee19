"""Layered overlays and keyed joins: last writer wins, upserts, weaker keys, children folded into parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import repairs as R


def last_wins(layers: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The value of the last row of each key, by order; a partial aggregate, no sort."""
    return layers.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def lay_over(base: DataFrame, patch: DataFrame, keys: list[str], value: str) -> DataFrame:
    """base with patch's values where there are any; keys that only patch has are added. Adds changed."""
    p = patch.select(*keys, F.col(value).alias("_new"))
    out = base.join(p, keys, "full_outer")
    return out.withColumn("changed", F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(value))).withColumn(value, F.coalesce("_new", value)).drop("_new")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Union of keys; the right side's values win."""
    r = new.select(*keys, *(F.col(v).alias(f"_{v}") for v in values))
    return old.select(*keys, *values).join(r, keys, "full_outer").select(*keys, *(F.coalesce(f"_{v}", v).alias(v) for v in values))


def merge_rewritten(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of old whose keys new doesn't rewrite, and all of new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def fallback(df: DataFrame, strong: DataFrame, weak: DataFrame, on_strong: list[str], on_weak: list[str], value: str) -> DataFrame:
    """value by the strong key, else by the weak key."""
    a = strong.select(*on_strong, F.col(value).alias("_a"))
    b = weak.select(*on_weak, F.col(value).alias("_b"))
    return df.join(a, on_strong, "left").join(b, on_weak, "left").withColumn(value, F.coalesce("_a", "_b")).drop("_a", "_b")


def fold_children(df: DataFrame, key: str, parent: Column, item: Column, order: str, into: str) -> DataFrame:
    """Rows without a parent, with an array of their children's items; children go. Those whose parent is missing are told by orphans()."""
    kids = df.where(parent.isNotNull()).groupBy(parent.alias(key)).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("x")))), lambda s: s["x"]).alias(into))
    return df.where(parent.isNull()).join(kids, key, "left").withColumn(into, F.coalesce(into, F.array().cast("array<string>")))


def orphans(df: DataFrame, key: str, parent: Column) -> DataFrame:
    """Rows that name a parent that isn't there: fold_children() has no place for them."""
    there = df.where(parent.isNull()).select(F.col(key).alias("_k")).distinct()
    return df.where(parent.isNotNull()).join(there, parent == F.col("_k"), "left_anti")


def distinct_ignoring_case(items: Column) -> Column:
    """The items once each whatever their case, in the order and spelling of their first place; nulls are left out. Spellings are told apart first, by a
    hash; only where two of them have the same small letters are they sorted by these, so that equals stand together. Each step is computed once."""
    def first_spellings(own: Column) -> Column:
        named = F.array_sort(F.transform(own, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x"))))
        kept = R.bound(named, lambda s: F.filter(s, lambda p, i: ~p["k"].eqNullSafe(F.get(s, i - 1)["k"])))
        return F.transform(F.array_sort(F.transform(kept, lambda p: F.struct(p["i"].alias("i"), p["x"].alias("x")))), lambda s: s["x"])

    once = F.array_distinct(F.filter(items, lambda x: x.isNotNull()))
    return R.bound(once, lambda own: F.when(F.size(F.array_distinct(F.transform(own, F.lower))) == F.size(own), own).otherwise(first_spellings(own)))


def ordered_distinct(df: DataFrame, key: str, item: str, order: str, into: str) -> DataFrame:
    """(key, into): each key's distinct items in the order of their first row; a key's items are aggregated one by one before they are listed."""
    first = df.groupBy(key, item).agg(F.min(order).alias("_o"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", item))), lambda s: s[item]).alias(into))


def shift_keys(df: DataFrame, offsets: DataFrame, on: str, line: str, col: str) -> DataFrame:
    """Keys moved by the offsets of their page, none where there are none."""
    return df.join(offsets, on, "left").withColumn(line, F.col(line) + F.coalesce("d_line", F.lit(0))).withColumn(col, F.col(col) + F.coalesce("d_col", F.lit(0))).drop("d_line", "d_col")


def set_changes(old: DataFrame, new: DataFrame, key: str, label: str) -> DataFrame:
    """(key, every, kept, added, dropped): what became of each key's set of labels from old to new, as sorted arrays. Labels are told apart by one aggregate over
    both tables, so neither set is gathered before its repeats are gone; null labels are no labels."""
    both = old.select(key, F.col(label).alias("_l"), F.lit(1).alias("_o"), F.lit(0).alias("_n")).unionByName(new.select(key, F.col(label).alias("_l"), F.lit(0).alias("_o"), F.lit(1).alias("_n")))
    each = both.groupBy(key, "_l").agg(F.max("_o").alias("_o"), F.max("_n").alias("_n"))
    of = lambda test, name: F.array_sort(F.collect_set(F.when(test, F.col("_l")))).alias(name)
    had, has = F.col("_o") == 1, F.col("_n") == 1
    return each.groupBy(key).agg(of(had | has, "every"), of(had & has, "kept"), of(has & ~had, "added"), of(had & ~has, "dropped"))
