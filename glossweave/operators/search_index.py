"""Ranked search of many queries at once over an index, with the ranks of `search`.

The index is four tables that a query meets by equality; nothing is scanned once a query:

* `forms`: each distinct form with the keys of its records;
* `grams`: runs of one to three characters of each form, and of each distinct body, so that what contains a query is looked up by the query's rarest run;
* `pieces`: each form in three pieces by its length. Two edits leave one piece whole, moved by two places at most, so a query meets a form within two edits
  at one of a few pieces of its own;
* `counts`: how many forms or bodies a run has.

Candidates are tested exactly. The tables can be written as bucketed Parquet and opened again.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import keep

GRAM = 3
EDITS = 2
#: Queries of fewer characters have no near forms.
NEAR = 4


@dataclass
class Index:
    forms: DataFrame
    bodies: DataFrame
    grams: DataFrame
    pieces: DataFrame
    counts: DataFrame

    def save(self, path: str, buckets: int = 16, schema: str = "search_index") -> None:
        """Each table as bucketed Parquet under path, by the column that queries meet."""
        for f, by in zip(fields(self), ("form", "body", "gram", "piece", "gram")):
            df = getattr(self, f.name)
            df.write.format("parquet").bucketBy(buckets, by).sortBy(by).option("path", f"{path}/{f.name}").mode("overwrite").saveAsTable(f"{schema}_{f.name}")

    @staticmethod
    def load(spark: SparkSession, schema: str = "search_index") -> Index:
        return Index(*(spark.table(f"{schema}_{f.name}") for f in fields(Index)))


def runs(c: Column, size: int) -> Column:
    """The distinct runs of that many characters."""
    return F.when(F.length(c) >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - size + 1), lambda i: F.substring(c, i, F.lit(size)))))


def cut_at(length: Column, i: int) -> Column:
    """Where piece i of a form of that length begins, from 0; pieces differ by one character at most."""
    return F.floor(length * i / (EDITS + 1)).cast("int")


def build(df: DataFrame, key: str, forms: Column, body: Column) -> Index:
    """The index of a table's records: forms is an array of strings in lower case, body a string. Null forms are left out, as are null bodies."""
    entries = keep(df.select(F.col(key).alias("key"), F.explode(forms).alias("form")).where("form is not null").distinct(), "forms")
    bodies = keep(df.select(F.col(key).alias("key"), F.lower(body).alias("body")).where("body is not null").distinct(), "bodies")
    words = entries.select("form").distinct()
    grams = None
    for kind, texts, col in ((0, words, "form"), (1, bodies.select("body").distinct(), "body")):
        for size in range(1, GRAM + 1):
            step = texts.select(F.lit(kind).alias("kind"), F.explode(runs(F.col(col), size)).alias("gram"), F.col(col).alias("target"))
            grams = step if grams is None else grams.unionByName(step)
    grams = keep(grams, "grams")
    size = F.length("form")
    cuts = F.array(*(F.struct(F.lit(i).alias("no"), F.expr("substring(form, {0} + 1, {1} - {0})".format(f"cast(floor(length(form) * {i} / {EDITS + 1}) as int)", f"cast(floor(length(form) * {i + 1} / {EDITS + 1}) as int)")).alias("piece")) for i in range(EDITS + 1)))
    pieces = keep(words.where(size > EDITS).select("form", size.alias("size"), F.explode(cuts).alias("c")).select("form", "size", "c.no", "c.piece"), "pieces")
    counts = grams.groupBy("kind", "gram").agg(F.count("*").alias("n"))
    return Index(entries, bodies, grams, pieces, keep(counts, "counts"))


def containing(index: Index, queries: DataFrame, kind: int) -> DataFrame:
    """(q, target): forms (kind 0) or bodies (kind 1) that contain a query, met on the query's run of fewest targets."""
    size = F.least(F.length("q"), F.lit(GRAM))
    asked = queries.where("q <> ''").select("q", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("q") - size + 1), lambda i: F.substring(F.col("q"), i, size)))).alias("gram"))
    known = asked.join(index.counts.where(F.col("kind") == kind), "gram", "left").groupBy("q").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return known.join(index.grams.where(F.col("kind") == kind), "gram").where(F.contains("target", "q")).select("q", "target")


def near(index: Index, queries: DataFrame) -> DataFrame:
    """(q, target): forms within two edits of a query of NEAR characters or more."""
    asked = queries.where(F.length("q") >= NEAR)
    probes = asked.select("q", F.explode(F.sequence(F.length("q") - EDITS, F.length("q") + EDITS)).alias("size"))
    probes = probes.select("q", "size", F.explode(F.sequence(F.lit(0), F.lit(EDITS))).alias("no"))
    at, to = F.floor(F.col("size") * F.col("no") / (EDITS + 1)).cast("int"), F.floor(F.col("size") * (F.col("no") + 1) / (EDITS + 1)).cast("int")
    probes = probes.select("q", "size", "no", (to - at).alias("width"), F.explode(F.sequence(at - EDITS, at + EDITS)).alias("at")).where("at >= 0 and at + width <= length(q)")
    probes = probes.where(F.col("size") > EDITS).select("q", "size", "no", F.expr("substring(q, at + 1, width)").alias("piece")).distinct()
    met = probes.join(index.pieces, ["size", "no", "piece"]).select("q", F.col("form").alias("target"))
    # A form of two characters is two edits away only from queries of four that hold both in order.
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(NEAR - 1)), lambda i: F.transform(F.sequence(i + 1, F.lit(NEAR)), lambda j: F.concat(F.substring(F.col("q"), i, F.lit(1)), F.substring(F.col("q"), j, F.lit(1))))))
    tiny = asked.where(F.length("q") == NEAR).select("q", F.explode(F.array_distinct(pairs)).alias("target")).join(index.forms.select(F.col("form").alias("target")).distinct(), "target", "left_semi")
    return met.unionByName(tiny.select("q", "target")).distinct().withColumn("d", F.levenshtein("q", "target", EDITS)).where("d >= 0")


def search(index: Index, queries: DataFrame, query: str) -> DataFrame:
    """(q, key, rank) for every distinct query, trimmed and in lower case, and every record it finds: 0 equal to a form, 1 at its start, 2 inside, 3 and 4 within as
    many edits less two (queries of four characters or more), 5 in the body. An empty query finds all records at rank 0; a null one none."""
    asked = keep(queries.select(F.lower(F.trim(F.col(query))).alias("q")).where("q is not null").distinct(), "queries")
    inside = containing(index, asked, 0).withColumn("rank", F.when(F.col("q") == F.col("target"), 0).when(F.startswith("target", "q"), 1).otherwise(2))
    ranked = inside.unionByName(near(index, asked).select("q", "target", F.when(F.col("d") == 0, 0).otherwise(F.col("d") + 2).alias("rank")))
    best = ranked.groupBy("q", "target").agg(F.min("rank").alias("rank"))
    rows = best.join(index.forms, F.col("target") == F.col("form")).select("q", "key", "rank")
    body = containing(index, asked, 1).join(index.bodies, F.col("target") == F.col("body")).select("q", "key", F.lit(5).alias("rank"))
    out = rows.unionByName(body).groupBy("q", "key").agg(F.min("rank").cast("int").alias("rank"))
    # At most one query is empty.
    every = index.forms.select("key").union(index.bodies.select("key")).distinct().crossJoin(F.broadcast(asked.where("q = ''"))).select("q", "key", F.lit(0).alias("rank"))
    return out.unionByName(every)


def top(hits: DataFrame, records: DataFrame, key: str, order: list[str], limit: int) -> DataFrame:
    """The first rows of every query by rank and then the order columns of the records: hits with those columns and place, 1 to limit."""
    met = hits.join(records.select(F.col(key).alias("key"), *[c for c in order if c != "key"]), "key")
    place = F.row_number().over(Window.partitionBy("q").orderBy("rank", *order))
    return met.withColumn("place", place).where(F.col("place") <= limit)
