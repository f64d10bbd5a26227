"""The reports and dashboard panels over the tables of a running scoring job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.config import SinkPaths
from txnscore.functions import buckets
from txnscore.operators import deciding, histograms, metrics, rates, reports
from txnscore.schemas import BATCH_METRICS, BATCH_SERIES, FAILURES, REJECTS, SENT, TRANSACTIONS
from txnscore.sinks.tables import read_table

# Ranges and quantiles of the panels, in seconds.
RATE_SECONDS = 60
LATENCY_SECONDS = 300
QUANTILES = [0.5, 0.95]


def _series(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    return read_table(spark, paths.batch_series, BATCH_SERIES)


def _sent(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    return read_table(spark, paths.sent, SENT)


def _metrics(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    return read_table(spark, paths.batch_metrics, BATCH_METRICS)


def _transactions(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    return read_table(spark, paths.transactions, TRANSACTIONS)


def throughput(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Transactions sent and processed per second in each minute."""
    processed = _series(spark, paths).select("processed_at", F.col("batch_size").alias("processed"))
    sent = _sent(spark, paths).select("processed_at", F.col("batch_size").alias("sent"))
    both = processed.unionByName(sent, allowMissingColumns=True)
    amounts = {"sent_per_second": F.col("sent"), "processed_per_second": F.col("processed")}
    return rates.windowed_rate(both, "processed_at", RATE_SECONDS, amounts=amounts)


def fraud_rates(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Frauds flagged and frauds labelled per second in each minute."""
    amounts = {"detected_per_second": F.col("fraud_count"), "actual_per_second": F.col("actual_count")}
    return rates.windowed_rate(_series(spark, paths), "processed_at", RATE_SECONDS, amounts=amounts)


def inference_latency(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Median and 95 % bucket quantiles of the inference time, per five minutes."""
    placed = _series(spark, paths).withColumn(
        "window_start", F.window("processed_at", f"{LATENCY_SECONDS} seconds")["start"]
    )
    bounds = buckets.INFERENCE_SECONDS
    return histograms.histogram_quantile(placed, "inference_seconds", bounds, QUANTILES, "window_start")


def _scores(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    return histograms.merge_histogram_arrays(_series(spark, paths), "score_buckets", len(buckets.SCORE))


def issues(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Rejected records by reason."""
    stored = read_table(spark, paths.rejects, REJECTS)
    return stored.groupBy("issue").agg(F.count("*").alias("n_rows"))


def failures(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Failed attempts by sink."""
    return metrics.failure_counters(read_table(spark, paths.failures, FAILURES))


REPORTS: dict[str, Callable[[SparkSession, SinkPaths], DataFrame]] = {
    "health": lambda spark, paths: reports.health_count(_transactions(spark, paths)),
    "transactions": lambda spark, paths: reports.recent_transactions(_transactions(spark, paths)),
    "high-confidence": lambda spark, paths: deciding.high_confidence_stored(_transactions(spark, paths)),
    "fraud": lambda spark, paths: reports.fraud_summary(_transactions(spark, paths)),
    "batches": lambda spark, paths: reports.recent_batches(_metrics(spark, paths)),
    "throughput": throughput,
    "fraud-rates": fraud_rates,
    "latest-rate": lambda spark, paths: metrics.latest_rate(_metrics(spark, paths)),
    "counters": lambda spark, paths: metrics.running_counters(_metrics(spark, paths)),
    "sent": lambda spark, paths: metrics.running_counters(_sent(spark, paths), metrics.SENT),
    "batch-counts": lambda spark, paths: metrics.batch_count_series(_metrics(spark, paths)),
    "latency": inference_latency,
    "failures": failures,
    "scores": lambda spark, paths: histograms.histogram_rows(_scores(spark, paths), buckets.SCORE),
    "score-ranges": lambda spark, paths: histograms.bucket_differences(_scores(spark, paths), buckets.SCORE),
    "batch-sizes": lambda spark, paths: histograms.bucket_histogram(
        _series(spark, paths), "batch_size", buckets.BATCH_SIZE
    ),
    "batch-times": lambda spark, paths: histograms.bucket_histogram(
        _series(spark, paths), "batch_seconds", buckets.BATCH_SECONDS
    ),
    "inference-times": lambda spark, paths: histograms.bucket_histogram(
        _series(spark, paths), "inference_seconds", buckets.INFERENCE_SECONDS
    ),
    "send-times": lambda spark, paths: histograms.bucket_histogram(
        _sent(spark, paths), "send_seconds", buckets.SEND_SECONDS
    ),
    "issues": issues,
}
