"""Queries that need Python or a fitted model: rows only, or SQL where the result has a plain form."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import lexicon, matching, order
from .base import query, table


@query("select p_partkey, strip_accents(p_name || ' Ångström façade naïve') as folded from part")
def fold_any_script(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", udfs.fold_nfd()(F.concat("p_name", F.lit(" Ångström façade naïve"))).alias("folded"))


@query()
def sequence_ratio(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    both = matching.near_strings(names.withColumn("k", F.col("p_name")), "k", "p_name", 0.85).select(F.col("x").alias("p_name"), F.col("y").alias("other"))
    return both.select("p_name", "other", F.round(udfs.sequence_ratio()("p_name", "other"), 6).alias("ratio")).where("ratio >= 0.85")


@query()
def viterbi_order(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("shelf", F.floor(F.col("p_partkey") / 100))
    return order.viterbi(part, "shelf", "p_partkey", "p_name", lexicon.CONFUSABLE)


@query()
def kmeans_cluster(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=10, seed=0, distanceMeasure="cosine", predictionCol="cluster").fit(emb)
    return model.transform(emb).select("vec_id", "cluster")


@query()
def leader_clusters(spark, sf_dir):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        rows["leader"] = udfs.leaders(np.stack(rows["embedding"].to_list()).astype(float), 0.5)
        return rows[["vec_id", "label", "leader"]]

    return table(spark, sf_dir, "embeddings").groupBy("label").applyInPandas(run, "vec_id long, label int, leader long")


@query()
def bracket_repair(spark, sf_dir):
    text = F.concat(F.when(F.col("doc_id") % 3 == 0, "(").when(F.col("doc_id") % 3 == 1, ") ").otherwise(""), "text")
    return table(spark, sf_dir, "documents").select("doc_id", udfs.bracket_repair()(text).alias("text"))


@query()
def span_marks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", udfs.span_marks(["the", "in the", "der", "que", "les"])(F.col("text")).alias("text"))


@query()
def reglue_lines(spark, sf_dir):
    lines = F.split(F.regexp_replace("text", "([a-z]{3})([a-z]{3}) ", "$1-\n$2 "), "\n")
    return table(spark, sf_dir, "documents").select("doc_id", udfs.reglue_lines({"and-the"}, {"the", "and", "with"})(lines).alias("text"))
