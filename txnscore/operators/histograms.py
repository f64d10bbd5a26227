"""Histograms with inclusive upper bounds and quantiles read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.functions.buckets import bound_labels, bucket_counts, cumulative_counts, quantile_from_counts


def histogram_arrays(df: DataFrame, col: str, bounds: Sequence[float], *group: str) -> DataFrame:
    """One row per group with the array of cumulative counts, +Inf last.

    A single hash aggregation: every bound is a column of the aggregate, so no bucket can be missing and
    neither a join nor a window is needed.
    """
    return df.groupBy(*group).agg(cumulative_counts(F.col(col), bounds).alias("cumulative"))


def merge_histogram_arrays(df: DataFrame, counts_col: str, n_bounds: int, *group: str) -> DataFrame:
    """Adds up stored arrays of bucket counts, e.g. one per micro-batch, into cumulative counts."""
    sums = [F.coalesce(F.sum(F.get(counts_col, F.lit(i))), F.lit(0)).cast("long") for i in range(n_bounds + 1)]
    merged = df.groupBy(*group).agg(F.array(*sums).alias("counts"))
    running = F.transform(
        F.sequence(F.lit(1), F.lit(n_bounds + 1)),
        lambda n: F.aggregate(F.slice("counts", F.lit(1), n), F.lit(0).cast("long"), lambda total, c: total + c),
    )
    return merged.select(*group, running.alias("cumulative"))


def histogram_rows(arrays: DataFrame, bounds: Sequence[float], *group: str) -> DataFrame:
    """One row per group and bucket: position, bound, own count and cumulative count."""
    labels = F.array(*[F.lit(label) for label in bound_labels(bounds)])
    zipped = F.arrays_zip(
        labels.alias("le"),
        bucket_counts(F.col("cumulative")).alias("bucket_count"),
        F.col("cumulative").alias("cumulative_count"),
    )
    exploded = arrays.select(*group, F.posexplode(zipped).alias("bucket", "entry"))
    return exploded.select(*group, "bucket", "entry.le", "entry.bucket_count", "entry.cumulative_count")


def bucket_histogram(df: DataFrame, col: str, bounds: Sequence[float], *group: str) -> DataFrame:
    return histogram_rows(histogram_arrays(df, col, bounds, *group), bounds, *group)


def bucket_differences(arrays: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Counts between neighbouring positive bounds; the first entry counts everything up to its bound."""
    positive = [i for i, bound in enumerate(bounds) if bound > 0]
    entries = []
    for place, i in enumerate(positive):
        upper = F.get("cumulative", F.lit(i))
        lower = F.get("cumulative", F.lit(positive[place - 1])) if place else F.lit(0).cast("long")
        name = f"< {bounds[i]}" if place == 0 else f"{bounds[positive[place - 1]]}-{bounds[i]}"
        entries.append(F.struct(F.lit(name).alias("score_range"), (upper - lower).alias("n_rows")))
    return arrays.select(F.inline(F.array(*entries)))


def histogram_quantile(
    df: DataFrame, col: str, bounds: Sequence[float], quantiles: Sequence[float], *group: str
) -> DataFrame:
    """Quantiles estimated from bucket counts, one column ``p<percent>`` each; not an exact percentile."""
    return quantiles_of(histogram_arrays(df, col, bounds, *group), bounds, quantiles, *group)


def quantile_name(q: float) -> str:
    """``p95`` for 0.95, ``p99_9`` for 0.999."""
    return f"p{q * 100:g}".replace(".", "_")


def quantiles_of(arrays: DataFrame, bounds: Sequence[float], quantiles: Sequence[float], *group: str) -> DataFrame:
    return arrays.select(
        *group,
        *[quantile_from_counts(F.col("cumulative"), bounds, q).alias(quantile_name(q)) for q in quantiles],
    )
