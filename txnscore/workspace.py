"""Shared scratch folders for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# A scan is spread when the cores are at least this many times its partitions.
IDLE_FACTOR = 4


def shared_root(spark: SparkSession) -> str:
    """The folder every executor reaches; a local temporary folder only on a local master."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="txnscore-")
    spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from a table in the shared folder, computed once whatever follows."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Gives the rows of a plain scan to all cores when it would leave most of them idle.

    Any other scan is left as it is, since a shuffle would cost more than it gains.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * IDLE_FACTOR <= cores else scan
