"""Transactions, records and batches derived from the ``events`` and ``embeddings`` tables.

Every event is one transaction. Its components come from the embedding whose ``vec_id`` is the event id
modulo the number of embeddings: all rows of both tables are used, and the first 28 entries of each vector.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.functions.messages import transaction_id
from txnscore.operators.deciding import ACTUAL, SCORE, decide
from txnscore.operators.metrics import batch_stats
from txnscore.operators.producing import build_messages, to_keyed_records
from txnscore.schemas import COMPONENTS, COUNTRIES
from txnscore.workspace import spread

BATCH_ROWS = 500
PARTITIONS = 3
RESENT_EVERY = 10
RESENT_OFFSET = 1_000_000_000_000

# At most this many vectors, about 25 MB, are sent to every task; more are joined by a shuffle.
BROADCAST_VECTORS = 100_000

# 2024-01-01 00:00:00 UTC, where ``Time`` starts.
START_SECONDS = 1_704_067_200

# Weights of the fixed logistic score: intercept, then feature weights. It predicts nothing.
INTERCEPT = -2.0
WEIGHTS = {"V1": 8.0, "V2": -6.0, "V3": 4.0, "Amount": 0.004}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _arrival_columns() -> dict[str, Column]:
    event, user = F.col("event_id"), F.col("user_id")
    batch = F.floor(event / BATCH_ROWS)
    return {
        "Time": (F.unix_micros(F.col("ts").cast("timestamp")) - START_SECONDS * 1_000_000) / 1e6,
        "Amount": F.col("value"),
        "merchant_id": F.format_string("MERCHANT-%04d", event * 7 % 1000 + 1),
        "card_last_four": (user % 9000 + 1000).cast("string"),
        "country": F.get(F.lit(COUNTRIES), (user % len(COUNTRIES)).cast("int")),
        "partition": (event % PARTITIONS).cast("int"),
        "offset": F.floor(event / PARTITIONS),
        "batch_id": batch,
        "processing_time_ms": (batch % 60 + 20).cast("double"),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an event alone tells about its transaction."""
    return as_arrivals(read(spark, sf_dir, "events"))


def as_arrivals(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", *_named(_arrival_columns()))


def transactions(spark: SparkSession, sf_dir: str, costly: bool = False) -> DataFrame:
    """Labelled transactions with all features; Catalyst drops the components a query does not read.

    ``costly`` announces much work per row, for which a scan of few partitions is spread over all cores.
    """
    embeddings = read(spark, sf_dir, "embeddings")
    n_vectors = embeddings.count()
    components = [f"CAST(embedding[{i}] AS DOUBLE) AS {name}" for i, name in enumerate(COMPONENTS)]
    vectors = embeddings.selectExpr("vec_id", "CAST(label = 0 AS INT) AS Class", *components)
    if n_vectors <= BROADCAST_VECTORS:
        vectors = F.broadcast(vectors)
    events = read(spark, sf_dir, "events")
    if costly:
        events = spread(events)
    return events.join(vectors, F.col("event_id") % n_vectors == F.col("vec_id")).select(
        "event_id",
        "ts",
        "vec_id",
        transaction_id(F.col("event_id")).alias("transaction_id"),
        *_named(_arrival_columns()),
        *COMPONENTS,
        "Class",
        F.col("Class").alias(ACTUAL),
    )


def logistic_score() -> Column:
    total = F.lit(INTERCEPT)
    for name, weight in WEIGHTS.items():
        total = total + F.lit(weight) * F.col(name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def with_logistic_score(df: DataFrame) -> DataFrame:
    return df.withColumn(SCORE, logistic_score())


def logistic_factory():
    """The same score as a Python model over Arrow batches.

    Everything the workers need is in the closure, so they need not have this package installed.
    """
    intercept, weights = INTERCEPT, dict(WEIGHTS)

    def load():
        def predict(batch: pd.DataFrame) -> np.ndarray:
            total = np.full(len(batch), intercept)
            for name, weight in weights.items():
                total = total + weight * batch[name].to_numpy()
            return 1.0 / (1.0 + np.exp(-total))

        return predict

    return load


def decided(spark: SparkSession, sf_dir: str, costly: bool = False) -> DataFrame:
    return decide(with_logistic_score(transactions(spark, sf_dir, costly)))


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per batch of 500 events, as the scoring job would have stored it."""
    actual = F.count_if(F.col(ACTUAL) == 1)
    stats = batch_stats(decided(spark, sf_dir), "batch_id", last_ts=F.max("ts"), actual_count=actual)
    return stats.withColumn("processing_ms", (F.col("batch_id") % 60 + 20).cast("double"))


def records(spark: SparkSession, sf_dir: str, defects: bool = False, resent: bool = False) -> DataFrame:
    """Transactions as Kafka-shaped records.

    With ``defects``, every 97th value is not JSON, every 89th lacks its id, every 83rd names a country of
    three letters and every 79th has no label. With ``resent``, the records are those sent a second time:
    every tenth transaction at a later offset, its amount raised by 1.
    """
    rows = transactions(spark, sf_dir, costly=True)
    event = F.col("event_id")
    if resent:
        rows = rows.where(event % RESENT_EVERY == 0).withColumns(
            {"Amount": F.col("Amount") + 1, "offset": F.col("offset") + RESENT_OFFSET}
        )
    if defects:
        rows = rows.withColumns(
            {
                "country": F.when(event % 83 == 0, F.concat("country", F.lit("X"))).otherwise(F.col("country")),
                "Class": F.when(event % 79 != 0, F.col("Class")),
            }
        )
    beside = ("event_id", "ts", "partition", "offset")
    messages = build_messages(rows, "event_id", "ts", keep=beside)
    if defects:
        messages = messages.withColumn("transaction_id", F.when(event % 89 != 0, F.col("transaction_id")))
    keyed = to_keyed_records(messages, "event_id", keep=beside)
    if defects:
        broken = F.lit("not json").cast("binary")
        keyed = keyed.withColumn("value", F.when(event % 97 == 0, broken).otherwise(F.col("value")))
    return keyed.select(
        "key",
        "value",
        F.lit("raw_transactions").alias("topic"),
        "partition",
        "offset",
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
