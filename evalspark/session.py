"""Session settings a job on this library wants, and where it may write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only; executor sizes and shuffle partitions stay the cluster's business.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here was planned with."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


#: Rows of a small table that one task writes.
TASK_ROWS = 1 << 17


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Unset is only acceptable on a single machine (tests, laptops), where a temporary folder is
    made and remembered for the session.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    remembered = getattr(spark, "_evalspark_dir", None)
    if remembered is None:
        remembered = tempfile.mkdtemp(prefix="evalspark-")
        spark._evalspark_dir = remembered
    return remembered


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so a retry cannot meet old files."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table whose consumers are all written; one outside the shared folder is
    refused, one already gone is no error."""
    if not path.startswith(shared_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not an intermediate table")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """A table of at most `rows` rows in a task per TASK_ROWS of them at most, for a small table to be
    written in few files, not by every shuffle partition. A bound that is too low costs speed only."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once as parquet in the shared folder and read back: a checkpoint that survives lost
    executors, keeps column pruning and can be reused by many plans."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
