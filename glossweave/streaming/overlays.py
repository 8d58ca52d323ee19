"""Streams: correction layers upserted as they come, late-tolerant counts, sessions. Extensions of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery



def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window and keys; rows later than the watermark are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, time: str, keys: list[str], gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def upsert_stream(changes: DataFrame, path: str, keys: list[str], value: str, order: list[str], checkpoint: str, kept: int = 2) -> StreamingQuery:
    """Keep at path the last value of each key.

    A batch lays its own last values over the version that the pointer names, writes the next version beside it, names that in the pointer, and
    deletes versions older than the last `kept`. A batch that runs twice starts from the version its number comes after, so it does no harm; a
    version whose write didn't end is never named.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        versions = [v for v in named(spark, path) if v < number]
        new = batch.select(*keys, value, *order)
        if versions:
            new = spark.read.parquet(f"{path}/v{max(versions)}").unionByName(new)
        newest = new.groupBy(*keys).agg(F.max_by(F.struct(value, *order), F.struct(*order)).alias("s")).select(*keys, "s.*")
        newest.write.mode("overwrite").parquet(f"{path}/v{number}")
        point(spark, path, number)
        for v in sorted(named(spark, path))[:-kept]:
            at, system = place(spark, f"{path}/v{v}")
            system.delete(at, True)
            at, system = place(spark, f"{path}/_named/v{v}")
            system.delete(at, False)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def place(spark, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def point(spark, path: str, number: int) -> None:
    """Name a version whose write has ended: an empty file of its name, made at once or not at all."""
    at, system = place(spark, f"{path}/_named/v{number}")
    system.create(at, True).close()


def named(spark, path: str) -> list[int]:
    """The versions that are complete."""
    at, system = place(spark, f"{path}/_named")
    if not system.exists(at):
        return []
    found = [s.getPath().getName() for s in system.listStatus(at)]
    return [int(n[1:]) for n in found if n[1:].isdigit()]


def current(spark, path: str) -> DataFrame:
    """The newest complete version at path."""
    return spark.read.parquet(f"{path}/v{max(named(spark, path))}")


__all__ = ["current", "sessions", "upsert_stream", "windowed_counts"]
