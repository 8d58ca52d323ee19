"""What the training-data operators share: tables in the shared folder, batch sizes, Arrow views of text."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id wherever ids are compared: larger than any id.
NO_ID = (1 << 63) - 1
BATCH_BYTES = 4 << 20


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share. A session that names none gets a folder of its own if driver and executors are one process; on a
    cluster there is no folder to fall back to, as every machine would write to its own disk."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="glossweave-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stash(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as a table of the shared folder and read it back: cuts the lineage and outlives executors. What isn't dropped goes when the driver ends."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/stash-{uuid.uuid4().hex}-{name}"
    df.write.option("compression", codec).parquet(path)
    at, system = hadoop_path(spark, path)
    system.deleteOnExit(at)
    spark.sparkContext._jvm.System.gc()  # lets Spark delete the shuffle files that only this table needed
    return spark.read.schema(df.schema).parquet(path)


def drop_stash(df: DataFrame) -> None:
    """Delete the files of a stashed table that no later plan reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder."""
    at, system = hadoop_path(spark, path)
    system.delete(at, True)


def arrow_limits(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes too, as some texts are very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def free_name(names: list[str], base: str) -> str:
    """base, made longer until no column has that name."""
    while base.lower() in {n.lower() for n in names}:
        base += "_"
    return base


TRIM_SECONDS = 2.0
_trimmed = [0.0]


def give_back() -> None:
    """Hand memory that batches needed back to the system, now and then: workers are kept for later tasks, and what they hold counts."""
    if time.monotonic() - _trimmed[0] > TRIM_SECONDS:
        _trimmed[0] = time.monotonic()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def thrifty(f):
    """A function for mapInArrow that gives memory back at its end."""

    def run(batches):
        yield from f(batches)
        _trimmed[0] = 0.0
        give_back()

    return run


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, as doc_id and text, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Ids as int64, null as NO_ID."""
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64) if isinstance(column, pa.Array) else column.combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
