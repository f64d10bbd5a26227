"""Expressions that turn a fraud probability into a decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower edge of each severity band, and the band below all of them.
SEVERITY_BANDS = [(0.9, "CRITICAL"), (0.7, "HIGH"), (0.5, "MEDIUM")]
LOWEST_SEVERITY = "LOW"

# Fixed value: probability from which a transaction is listed as high-confidence fraud.
HIGH_CONFIDENCE = 0.9


def number_or_null(value: Column) -> Column:
    """NaN becomes NULL: Spark sorts NaN above every number, so comparisons would accept it."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def decision_flag(score: Column, threshold: float) -> Column:
    """True where the score reaches the threshold; NaN and NULL scores are never flagged."""
    return F.coalesce(number_or_null(score) >= F.lit(float(threshold)), F.lit(False))


def severity(score: Column) -> Column:
    known = number_or_null(score)
    band = F.lit(LOWEST_SEVERITY)
    for edge, name in reversed(SEVERITY_BANDS):
        band = F.when(known >= F.lit(edge), F.lit(name)).otherwise(band)
    return band


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 where the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def report_round(value: Column, digits: int) -> Column:
    """Half-up rounding to a decimal; NaN and values beyond 18 digits give NULL."""
    return value.try_cast(f"decimal(18,{digits})")
