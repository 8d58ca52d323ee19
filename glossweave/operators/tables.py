"""Tables of a plan's middle, kept in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a local session gets a folder of its own and any other is refused, as machines don't share theirs."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="glossweave-tables-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return own


def keep(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back, so that what isn't the same in a second run (places in a range, say) is fixed, and lost executors cost no more than
    their own part. The table goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a batch that goes to Python: by rows alone a batch holds 10,000 texts, however long.
BATCH_BYTES = 4 << 20


def arrow_limits(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes too, so what a Python task holds doesn't follow the texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
