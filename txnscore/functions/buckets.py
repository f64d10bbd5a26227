"""Histogram bounds and the expressions over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnscore.functions.decisions import number_or_null

# Upper bounds of each histogram; +Inf always closes the list.
INFERENCE_SECONDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
BATCH_SIZE = [1.0, 5.0, 10.0, 50.0, 100.0, 500.0, 1000.0, 5000.0]
BATCH_SECONDS = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0]
SCORE = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
SEND_SECONDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5]


def bound_label(bound: float) -> str:
    return str(float(bound))


def bound_labels(bounds: Sequence[float]) -> list[str]:
    return [*map(bound_label, bounds), "+Inf"]


def cumulative_counts(value: Column, bounds: Sequence[float]) -> Column:
    """Aggregate: how many values lie at or below each bound, then how many there are at all.

    Bounds are inclusive. NULL and NaN fall into no bucket, not even the last one.
    """
    known = number_or_null(value)
    counts = [F.count_if(known <= F.lit(float(bound))) for bound in bounds]
    return F.array(*counts, F.count(known))


def bucket_counts(cumulative: Column) -> Column:
    """Counts per bucket from cumulative counts."""
    shifted = F.concat(F.array(F.lit(0).cast("long")), cumulative)
    return F.zip_with(cumulative, F.slice(shifted, 1, F.size(cumulative)), lambda upper, lower: upper - lower)


def quantile_from_counts(cumulative: Column, bounds: Sequence[float], q: float) -> Column:
    """Quantile by linear interpolation inside the bucket that holds it.

    The first bucket starts at 0 when its bound is positive; otherwise its bound is the answer.
    A quantile beyond the last finite bound gives that bound. Without observations: NULL.
    """
    edges = F.array(*[F.lit(float(bound)) for bound in bounds])
    total = F.element_at(cumulative, -1)
    target = F.lit(float(q)) * total
    index = F.size(F.filter(cumulative, lambda count: count < target))
    upper = F.get(edges, index)
    lower = F.when(index > 0, F.get(edges, index - 1)).otherwise(F.lit(min(0.0, float(bounds[0]))))
    below = F.when(index > 0, F.get(cumulative, index - 1)).otherwise(F.lit(0).cast("long"))
    inside = F.get(cumulative, index) - below
    interpolated = lower + (upper - lower) * ((target - below) / F.nullif(inside, F.lit(0).cast("long")))
    answer = F.when(index >= len(bounds), F.lit(float(bounds[-1])))
    if bounds[0] <= 0:
        answer = answer.when(index == 0, F.lit(float(bounds[0])))
    return F.when(total > 0, answer.otherwise(interpolated))
