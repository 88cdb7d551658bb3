"""Session helpers: shared folder, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on rows sent to every executor; a dimension row here is well under
# 1 KB, so a broadcast stays below about 200 MB.
BROADCAST_ROWS = 200_000


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("portrisk")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="portrisk-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Cut lineage: write a table to the shared folder and go on from it.

    The rows are computed once and stay as they are, also when executors are
    lost; later reads can skip columns.
    """
    path = new_folder(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger side keeps Spark's shuffle join."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread_scan(df: DataFrame) -> DataFrame:
    """Give the rows of a few-file scan to all cores; a large scan is left alone.

    For plain scans in front of text work, which is far dearer than the shuffle
    of so little data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
