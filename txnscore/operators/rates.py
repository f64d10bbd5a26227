"""Event-time rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscore.functions.decisions import guarded_ratio


def windowed_rate(
    df: DataFrame,
    ts: str,
    window_seconds: int,
    slide_seconds: int | None = None,
    series: Mapping[str, Column] | None = None,
    amounts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rates per second in each event-time window.

    ``series`` maps an output name to the condition a row must meet to be counted, ``amounts`` one to the
    number a row adds, such as the size of a batch; without either, all rows count as ``rate``. ``n`` is the
    number of rows in the window. Rows are summed once per slide; the few slide totals, not the rows, are then
    copied into every window that covers them. Windows start at whole multiples of the slide.
    """
    totals = series_totals(series, amounts)
    panes = (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.window(ts, f"{slide_of(window_seconds, slide_seconds)} seconds").alias("span"))
        .agg(*[total.alias(name) for name, total in totals.items()], F.count("*").alias("n"))
        .withColumn("pane", F.col("span.start"))
    )
    return rates_of_panes(panes, list(totals), window_seconds, slide_seconds)


def slide_of(window_seconds: int, slide_seconds: int | None) -> int:
    slide = slide_seconds or window_seconds
    if window_seconds % slide:
        raise ValueError("the window must be a whole number of slides")
    return slide


def rates_of_panes(
    panes: DataFrame, names: list[str], window_seconds: int, slide_seconds: int | None = None
) -> DataFrame:
    """Rates per window from the totals of the slides that start at ``pane``."""
    slide = slide_of(window_seconds, slide_seconds)
    covering = window_seconds // slide
    if covering == 1:
        windows = panes.withColumn("window_start", F.col("pane"))
    else:
        shift = F.explode(F.sequence(F.lit(0), F.lit(covering - 1)))
        windows = (
            panes.withColumn("shift", shift)
            .withColumn("window_start", F.col("pane") - F.make_dt_interval(secs=F.col("shift") * slide))
            .groupBy("window_start")
            .agg(*[F.sum(name).alias(name) for name in [*names, "n"]])
        )
    return windows.select(
        "window_start", *[(F.col(name) / F.lit(float(window_seconds))).alias(name) for name in names], "n"
    )


def series_totals(
    series: Mapping[str, Column] | None = None, amounts: Mapping[str, Column] | None = None
) -> dict[str, Column]:
    """The aggregates behind the named rates."""
    if not series and not amounts:
        series = {"rate": F.lit(True)}
    totals = {name: F.count_if(condition) for name, condition in (series or {}).items()}
    return totals | {name: F.coalesce(F.sum(amount), F.lit(0)) for name, amount in (amounts or {}).items()}


def achieved_rate(df: DataFrame, ts: str) -> DataFrame:
    """Rows, elapsed seconds between first and last event, and rows per second."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    spans = df.agg(
        F.count("*").alias("n_rows"),
        ((F.max(micros) - F.min(micros)) / F.lit(1e6)).alias("elapsed_seconds"),
    )
    return spans.withColumn(
        "rows_per_second", F.coalesce(guarded_ratio(F.col("n_rows"), F.col("elapsed_seconds")), F.lit(0.0))
    )
