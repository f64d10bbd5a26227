"""The corpus pipeline: five stages over ``documents``, each on all that the stage before it kept.

A stage takes the rows as they were written by the one before and returns rows with the columns of ``documents``;
the last one adds the pieces. Duplicates and nulls are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm import common, exact_dedup, languages, mixing, near_dedup, pieces
from txnscore.workspace import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Five words to a shingle and a similarity of 0.8.
NEAR = near_dedup.Settings(words=5, percent=80)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without letters go."""
    return languages.with_known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id."""
    return near_dedup.without_near_duplicates(docs, settings=NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mixed(docs)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their sampled pieces; copies of a document get the same pieces."""
    return pieces.encode(docs, F.col("doc_id"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("sentencepiece", segment),
]

#: A trained network, a randomised join and sampled pieces are no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
