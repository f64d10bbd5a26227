"""Event-time series over streams, kept as totals in a table.

Each micro-batch adds the totals of its own rows, one row per slide or window, to a table that changes as a whole (see
``sinks.store``). The totals of all batches are summed when read, so a late row counts whenever it comes, open windows are
there, and several checkpoints on one table add up. A replayed batch takes the place of its first attempt. Old batches are
merged by summing them, so the table stays as small as its windows are many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from txnscore.functions.buckets import cumulative_counts
from txnscore.operators.histograms import quantiles_of
from txnscore.operators.rates import rates_of_panes, series_totals, slide_of
from txnscore.schemas import BATCH_ID
from txnscore.sinks.store import Store
from txnscore.sinks.tables import stored_batch_id

PANE = "pane"
_TOTALS = "totals"


def _schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(PANE, TimestampType()), *[StructField(name, LongType()) for name in names]])


def _summed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.groupBy(PANE).agg(*[F.sum(name).alias(name) for name in names])


def _start(
    df: DataFrame,
    ts: str,
    seconds: int,
    totals: Mapping[str, Column],
    path: str,
    checkpoint: str,
    available_now: bool,
) -> StreamingQuery:
    """Adds the totals of each micro-batch, by windows of so many seconds, to the table at ``path``."""
    store, names = Store(df.sparkSession, path), list(totals)
    run = store.run_number(checkpoint)

    def merge(rows: DataFrame) -> DataFrame:
        return _summed(rows, names).withColumn(BATCH_ID, F.lit(None).cast("long"))

    def add(batch: DataFrame, batch_id: int) -> None:
        number = stored_batch_id(run, batch_id)
        pane = F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds")["start"].alias(PANE)
        sums = batch.where(F.col(ts).isNotNull()).groupBy(pane).agg(*[total.alias(name) for name, total in totals.items()])
        store.commit(number, [store.stage(_TOTALS, sums, number, 1)])
        store.compact({_TOTALS: (_schema(names), None)}, merge)

    writer = df.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def _totals(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    return _summed(Store(spark, path).read(_TOTALS, _schema(names)), names)


def start_pane_totals(
    df: DataFrame,
    ts: str,
    path: str,
    checkpoint: str,
    window_seconds: int,
    slide_seconds: int | None = None,
    series: Mapping[str, Column] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Sums a stream once per slide and keeps the totals at ``path``."""
    totals = {**series_totals(series), "n": F.count("*")}
    return _start(df, ts, slide_of(window_seconds, slide_seconds), totals, path, checkpoint, available_now)


def streamed_rate(
    spark: SparkSession,
    path: str,
    window_seconds: int,
    slide_seconds: int | None = None,
    series: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The rates of all windows so far, equal to ``operators.rates.windowed_rate`` over the rows seen."""
    names = list(series_totals(series))
    return rates_of_panes(_totals(spark, path, [*names, "n"]), names, window_seconds, slide_seconds)


def _bucket_names(bounds: Sequence[float]) -> list[str]:
    return [f"upto_{place}" for place in range(len(bounds) + 1)]


def start_bucket_totals(
    df: DataFrame,
    ts: str,
    value: Column,
    bounds: Sequence[float],
    path: str,
    checkpoint: str,
    window_seconds: int,
    available_now: bool = False,
) -> StreamingQuery:
    """Counts the values of a stream up to each bound, per window, and keeps the counts at ``path``."""
    counts = cumulative_counts(value, bounds)
    totals = {name: F.get(counts, F.lit(place)) for place, name in enumerate(_bucket_names(bounds))}
    return _start(df, ts, window_seconds, totals, path, checkpoint, available_now)


def streamed_quantiles(
    spark: SparkSession, path: str, bounds: Sequence[float], quantiles: Sequence[float]
) -> DataFrame:
    """Per window the quantiles of all values so far, equal to ``operators.histograms.histogram_quantile``."""
    names = _bucket_names(bounds)
    arrays = _totals(spark, path, names).select(F.col(PANE).alias("window_start"), F.array(*names).alias("cumulative"))
    return quantiles_of(arrays, bounds, quantiles, "window_start")
