"""From raw documents to a training mix: STAGES in order, each on all that its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossweave.llm import classify, decontaminate, mixing, near, secret_scan, simhash
from glossweave.llm.common import free_name, remove, scratch, stash, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects (score under 0.5)."""
    model = classify.fit_quality(docs, table(spark, sf_dir, "labels"))
    return classify.keep_quality(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near copies: five-word shingle sets with a similarity of 0.8 or more."""
    return near.dedup(docs, shingle=5, similarity=0.8)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak an item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and blots their secrets out."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with copies: how often. A column of that name in docs is replaced. Rows that id and size don't tell apart share
    their copies, as evenly as whole copies go, by the order of their hashes; a null id is an id like any other here."""
    docs = docs.drop("copies")
    rows = stash(mixing.mix(docs).select("doc_id", "size", "copies"), "mixed")
    n, distinct = rows.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if n == distinct:
        taken = rows.where("copies > 0").select("doc_id", "copies")
        return docs.join(F.broadcast(taken) if n <= simhash.BROADCAST_ROWS else taken, "doc_id").select(*docs.columns, "copies")
    words, key, size = (free_name(docs.columns, x) for x in ("words", "id", "size"))
    shares = rows.groupBy("doc_id", "size").agg(F.sum("copies").alias("all"), F.count("*").alias("rows")).select(F.col("doc_id").alias(key), F.col("size").alias(size), F.col("all").alias(free_name(docs.columns, "all")), F.col("rows").alias(free_name(docs.columns, "rows")))
    marked = mixing.sized(docs, "doc_id", "text", "source", keep=words)
    met = marked.join(shares, F.col(words).eqNullSafe(F.col(size)) & F.col("doc_id").cast("long").eqNullSafe(F.col(key)))
    total, many = F.col(shares.columns[2]), F.col(shares.columns[3])
    rest = total % many
    whole = met.where(rest == 0).withColumn("copies", (total / many).cast("long"))
    place = F.row_number().over(Window.partitionBy("doc_id", words).orderBy(F.xxhash64(*docs.columns)))
    odd = met.where(rest != 0).withColumn("copies", F.floor(total / many) + F.when(place <= rest, 1).otherwise(0))
    return whole.unionByName(odd).where("copies > 0").select(*docs.columns, "copies")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
]

#: The stages aren't expressible in SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again; a stage's table goes when the next one is written."""
    docs, base = table(spark, sf_dir, "documents"), f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        if i:
            remove(spark, f"{base}/{i - 1}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs
