"""Micro-batch statistics and the counters drawn from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscore.functions.decisions import guarded_ratio
from txnscore.operators.deciding import FLAG
from txnscore.operators.running import running_sums

# One day of five-second batches.
BATCHES_PER_BLOCK = 17_280


def batch_stats(decided: DataFrame, *keys: str, **also: Column) -> DataFrame:
    """Size, flagged rows and flagged share, per key or for the whole batch, and further aggregates by name."""
    sizes = decided.groupBy(*keys).agg(
        F.count("*").alias("batch_size"),
        F.count_if(FLAG).alias("fraud_count"),
        *[aggregate.alias(name) for name, aggregate in also.items()],
    )
    return sizes.withColumn("fraud_rate", guarded_ratio(F.col("fraud_count"), F.col("batch_size")))


# Counters and the batch columns they add up.
PROCESSED = {"processed_total": "batch_size", "fraud_total": "fraud_count"}
SENT = {"sent_total": "batch_size", "fraud_sent_total": "actual_count"}


def running_counters(
    metrics: DataFrame, counters: Mapping[str, str] = PROCESSED, batches_per_block: int = BATCHES_PER_BLOCK
) -> DataFrame:
    """Totals up to and including each batch; by default of rows processed and flagged."""
    block = F.floor(F.col("batch_id") / batches_per_block)
    needed = metrics.select("batch_id", *sorted(set(counters.values())))
    return running_sums(needed, block, "batch_id", counters).select("batch_id", *counters)


def batch_count_series(metrics: DataFrame, batches_per_block: int = BATCHES_PER_BLOCK) -> DataFrame:
    """Number of batches seen up to and including each batch."""
    block = F.floor(F.col("batch_id") / batches_per_block)
    counted = metrics.select("batch_id", F.lit(1).cast("long").alias("one"))
    return running_sums(counted, block, "batch_id", {"batches_total": "one"}).select("batch_id", "batches_total")


def latest_rate(metrics: DataFrame) -> DataFrame:
    """Flagged share of the last batch in percent."""
    return metrics.agg(F.max_by(F.col("fraud_rate") * 100, F.col("batch_id")).alias("fraud_rate_pct"))


def failure_counters(failures: DataFrame) -> DataFrame:
    """Per sink: failed attempts, batches that failed at it, and attempts that were retries of such batches."""
    counted = failures.groupBy("sink", "failed_batch").agg(F.count("*").alias("attempts"))
    return counted.groupBy("sink").agg(
        F.sum("attempts").alias("failures_total"),
        F.count("*").alias("failed_batches"),
        F.sum(F.col("attempts") - 1).alias("retries_failed"),
    )
