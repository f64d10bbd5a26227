"""From scores to decisions, alerts and stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscore.config import FRAUD_THRESHOLD
from txnscore.functions.decisions import HIGH_CONFIDENCE, decision_flag, report_round, severity
from txnscore.functions.messages import alert_id

SCORE = "fraud_probability"
FLAG = "is_fraud_predicted"
ACTUAL = "is_fraud_ground_truth"


def decide(df: DataFrame, threshold: float = FRAUD_THRESHOLD, score_col: str = SCORE) -> DataFrame:
    return df.withColumn(FLAG, decision_flag(F.col(score_col), threshold))


def alerts(decided: DataFrame, raised_at: Column | None = None) -> DataFrame:
    """Flagged rows as the nine alert fields; ``timestamp`` is the time of raising in epoch seconds."""
    moment = F.current_timestamp() if raised_at is None else raised_at
    return decided.where(F.col(FLAG)).select(
        alert_id(F.col("transaction_id")).alias("alert_id"),
        "transaction_id",
        (F.unix_micros(moment.cast("timestamp")) / F.lit(1e6)).alias("timestamp"),
        SCORE,
        F.col("Amount").cast("double").alias("amount"),
        "merchant_id",
        "country",
        "card_last_four",
        severity(F.col(SCORE)).alias("severity"),
    )


def alert_values(alert_rows: DataFrame) -> DataFrame:
    """Alerts as unkeyed JSON values for a topic."""
    return alert_rows.select(F.to_json(F.struct(*alert_rows.columns)).alias("value"))


def transaction_records(
    decided: DataFrame,
    processed_at: Column | None = None,
    processing_ms: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The stored columns of a transaction, and the columns in ``keep``.

    ``processing_time_ms`` is the inference time of the whole batch, repeated on each of its rows, so its
    mean over the table is weighted by batch size.
    """
    moment = F.current_timestamp() if processed_at is None else processed_at
    spent = F.col("processing_time_ms") if processing_ms is None else processing_ms
    return decided.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        moment.alias("processed_at"),
        F.col("Amount").cast("double").alias("amount"),
        F.col(SCORE).cast("double").alias(SCORE),
        FLAG,
        F.col(ACTUAL).cast("int").alias(ACTUAL),
        "merchant_id",
        "card_last_four",
        "country",
        spent.cast("double").alias("processing_time_ms"),
        *keep,
    )


def high_confidence_stored(stored: DataFrame, floor: float = HIGH_CONFIDENCE) -> DataFrame:
    """The same report over the table of transactions."""
    return high_confidence(stored.withColumnRenamed("amount", "Amount"), floor)


def high_confidence(df: DataFrame, floor: float = HIGH_CONFIDENCE) -> DataFrame:
    return df.where(decision_flag(F.col(SCORE), floor)).select(
        "transaction_id",
        report_round(F.col("Amount"), 2).alias("amount"),
        report_round(F.col(SCORE), 4).alias("score"),
        "country",
    )
