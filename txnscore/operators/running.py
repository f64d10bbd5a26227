"""Running sums that never put the whole table into one window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(
    df: DataFrame,
    block: Column,
    order: str,
    sums: Mapping[str, str],
    inclusive: bool = True,
    overall: Mapping[str, str] | None = None,
) -> DataFrame:
    """Adds running sums along ``order``, one output column per entry of ``sums`` (output -> input).

    ``block`` must grow with ``order``. Rows are totalled per block first; the totals, one row per block, get a
    running sum of their own, and each block is then summed in its own window. ``overall`` adds grand totals,
    which are taken from the block totals as well. Rows without a block are left out.
    """
    # Both branches filter and read alike, so that Spark shuffles their common input once.
    blocked = df.withColumn("_block", block).where(F.col("_block").isNotNull())
    inputs = sorted({*sums.values(), *(overall or {}).values()})
    totals = blocked.groupBy("_block").agg(*[F.sum(name).alias(f"_total_{name}") for name in inputs])
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_block",
        *[
            F.coalesce(F.sum(f"_total_{source}").over(earlier), F.lit(0)).alias(f"_before_{out}")
            for out, source in sums.items()
        ],
        *[F.sum(f"_total_{source}").over(everything).alias(out) for out, source in (overall or {}).items()],
    )
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return (
        blocked.join(offsets, "_block")
        .withColumns(
            {
                out: F.col(f"_before_{out}") + F.coalesce(F.sum(source).over(inside), F.lit(0))
                for out, source in sums.items()
            }
        )
        .drop("_block", *[f"_before_{out}" for out in sums])
    )
