"""Lines of text to dictionary records: cut, join, parse. Staged column expressions, one stage a step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD = "^[*+«]?[a-zà-ÿ'’()-]+!?»?\\."


def starts(lines: DataFrame) -> Column:
    """Does a line open a record: underlined from its first cell, or shaped like a headword after a blank line?"""
    w = Window.partitionBy("page").orderBy("k")
    blank = F.coalesce(F.trim(F.lag("text").over(w)) == "", F.lit(True))
    under = F.exists("underlines", lambda u: u["a"] == 0)
    return under | (blank & F.col("text").rlike(HEAD) & ~F.col("text").rlike("^[A-Z]{2}"))


def cut(lines: DataFrame) -> DataFrame:
    """(page, line, text): each record's lines joined; words broken by a hyphen before a small letter are joined without it."""
    named = lines.withColumn("start", starts(lines))
    run = Window.partitionBy("page").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    named = named.withColumn("n", F.sum(F.col("start").cast("int")).over(run)).where("n > 0 and trim(text) <> ''")
    g = named.groupBy("page", "n").agg(F.array_sort(F.collect_list(F.struct("k", F.trim("text").alias("t")))).alias("s"))
    joined = F.array_join(F.transform("s", lambda s: s["t"]), "\n")
    text = F.regexp_replace(F.regexp_replace(joined, "([a-zà-ÿ])-\\n([a-zà-ÿ])", "$1$2"), "\\s+", " ")
    return g.select("page", F.col("s")[0]["k"].alias("line"), text.alias("text"))


def adopt(records: DataFrame, orphans: DataFrame) -> DataFrame:
    """Text at the head of a page that no record holds goes to the last record of the page before, unless that ends in a code or a dash or the text is short."""
    last = records.groupBy("page").agg(F.max("line").alias("line")).join(records, ["page", "line"])
    ok = (F.length("orphan") >= 8) & F.col("orphan").contains(" ") & ~F.col("text").rlike("(-|[-.] [A-Z]{2,}\\.?)\\s*$")
    met = last.join(orphans.select((F.col("page") - 1).alias("page"), F.col("text").alias("orphan")), "page").where(ok).select("page", "line", "orphan")
    return records.join(met, ["page", "line"], "left").withColumn("text", F.concat_ws(" ", "text", "orphan")).drop("orphan")


def compact(records: DataFrame) -> DataFrame:
    """Published form: short names, empty values null so that writers leave them out."""
    empty = lambda c: F.when(F.size(c) > 0, F.col(c))
    return records.select(F.col("vedetto").alias("v"), F.col("fako").alias("f"), empty("lingui").alias("l"), F.transform("senci", lambda s: F.struct(s.alias("t"))).alias("b"), F.col("page").alias("p"), F.col("line").alias("g"), empty("drapeli").alias("d"), F.when(F.col("citita"), 1).alias("c"))
