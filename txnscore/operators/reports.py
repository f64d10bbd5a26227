"""Reports over datasets and sink tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.functions.decisions import guarded_ratio, report_round
from txnscore.operators.deciding import ACTUAL, FLAG, SCORE
from txnscore.schemas import LABEL


def class_profile(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, frauds, the rest, and both shares in percent."""
    counts = df.agg(F.count("*").alias("total"), F.count_if(F.col(label) == 1).alias("fraud"))
    counts = counts.withColumn("legitimate", F.col("total") - F.col("fraud"))
    return counts.withColumns(
        {
            "legitimate_pct": guarded_ratio(F.col("legitimate"), F.col("total")) * 100,
            "fraud_pct": guarded_ratio(F.col("fraud"), F.col("total")) * 100,
        }
    )


def split_profile(split: DataFrame, label: str = LABEL) -> DataFrame:
    """Size, frauds and fraud share of each part."""
    sizes = split.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_if(F.col(label) == 1).alias("fraud"))
    return sizes.withColumn("fraud_rate", guarded_ratio(F.col("fraud"), F.col("n_rows")))


def fraud_summary(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        F.count("*").alias("total"),
        F.sum(F.col(FLAG).cast("int")).alias("detected"),
        F.sum(ACTUAL).alias("actual"),
        report_round(F.avg(SCORE), 4).alias("avg_score"),
        report_round(F.avg("processing_time_ms"), 2).alias("avg_ms"),
    )


def health_count(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.count("*").alias("total"), F.sum(F.col(FLAG).cast("int")).alias("fraud"))


def recent_transactions(transactions: DataFrame, n: int = 10) -> DataFrame:
    """The last stored transactions; equal times are ordered by id."""
    latest = transactions.orderBy(F.col("processed_at").desc(), F.col("transaction_id").desc()).limit(n)
    return latest.select(
        "transaction_id",
        report_round(F.col("amount"), 2).alias("amount"),
        report_round(F.col(SCORE), 4).alias("score"),
        F.col(FLAG).alias("fraud"),
        "country",
        "processed_at",
    )


def recent_batches(metrics: DataFrame, n: int = 10) -> DataFrame:
    return (
        metrics.orderBy(F.col("batch_id").desc())
        .limit(n)
        .select(
            "batch_id",
            "batch_size",
            "fraud_count",
            report_round(F.col("fraud_rate") * 100, 3).alias("fraud_pct"),
            report_round(F.col("processing_ms"), 0).alias("ms"),
            "processed_at",
        )
    )
