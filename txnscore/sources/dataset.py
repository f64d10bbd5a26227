"""The labelled dataset as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscore.schemas import DATASET


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Header row and 31 columns, read with a fixed schema so that no pass is spent on inference.

    Header names are checked against the schema; a malformed number becomes NULL.
    """
    return spark.read.schema(DATASET).csv(path, header=True, enforceSchema=False, mode="PERMISSIVE")
