"""Column expressions at their edges."""

import math
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnscore.functions import buckets
from txnscore.functions.decisions import decision_flag, guarded_ratio, report_round, severity
from txnscore.functions.messages import epoch_seconds, iso_text, transaction_id

SCORES = [None, float("nan"), 0.0, 0.1, 0.49999, 0.5, 0.69999, 0.7, 0.89999, 0.9, 1.0]


def values(spark, data, expression, kind="double"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}")
    return [row["y"] for row in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_flag_ignores_nan_and_null(spark):
    flags = values(spark, SCORES, lambda x: decision_flag(x, 0.5))
    assert flags == [False, False, False, False, False, True, True, True, True, True, True]


def test_flag_at_threshold_zero(spark):
    assert values(spark, [None, float("nan"), 0.0], lambda x: decision_flag(x, 0.0)) == [False, False, True]


def test_severity_bands(spark):
    assert values(spark, SCORES, severity) == ["LOW"] * 5 + ["MEDIUM"] * 2 + ["HIGH"] * 2 + ["CRITICAL"] * 2


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (0, 0), (None, 2)], "a int, b int")
    ratios = [row[0] for row in df.select(guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert ratios == [0.25, 0.0, 0.0, None]


@pytest.mark.parametrize(
    "value, digits, expected",
    [(2.5, 0, "3"), (-2.5, 0, "-3"), (0.12345, 4, "0.1235"), (1.005, 2, "1.01"), (float("nan"), 2, None), (1e30, 2, None)],
)
def test_report_round(spark, value, digits, expected):
    assert values(spark, [value], lambda x: report_round(x, digits)) == [expected and Decimal(expected)]


def test_transaction_id_keeps_long_numbers(spark):
    numbers = values(spark, [1, 42, 99_999_999, 123_456_789], transaction_id, "bigint")
    assert numbers == ["TXN-00000001", "TXN-00000042", "TXN-99999999", "TXN-123456789"]


def test_times_follow_python(spark):
    moments = [datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2024, 1, 2, 3, 4, 5), datetime(1969, 12, 31, 23, 0, 0, 1)]
    assert values(spark, moments, iso_text, "timestamp_ntz") == [m.isoformat() for m in moments]
    expected = [(m - datetime(1970, 1, 1)).total_seconds() for m in moments]
    assert values(spark, moments, epoch_seconds, "timestamp_ntz") == expected


def cumulative(spark, data, bounds):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    return df.agg(buckets.cumulative_counts(F.col("x"), bounds).alias("c")).first()["c"]


def test_bounds_are_inclusive_and_nan_is_left_out(spark):
    data = [0.0, 0.1, 0.10001, 1.0, 1.5, float("nan"), None, -1.0]
    assert cumulative(spark, data, [0.0, 0.1, 1.0]) == [2, 3, 5, 6]


def test_infinity_falls_into_the_last_bucket(spark):
    assert cumulative(spark, [math.inf, 1.0], [1.0]) == [1, 2]


def quantile(spark, counts, bounds, q):
    df = spark.createDataFrame([(counts,)], "c array<bigint>")
    return df.select(buckets.quantile_from_counts(F.col("c"), bounds, q)).first()[0]


@pytest.mark.parametrize(
    "counts, bounds, q, expected",
    [
        ([0, 0, 0], [1.0, 2.0], 0.5, None),
        ([4, 4, 4], [1.0, 2.0], 0.5, 0.5),
        ([2, 4, 4], [1.0, 3.0], 0.75, 2.0),
        ([0, 4, 4], [1.0, 3.0], 0.5, 2.0),
        ([0, 0, 4], [1.0, 3.0], 0.5, 3.0),
        ([4, 4, 4], [0.0, 1.0], 0.5, 0.0),
        ([1, 4, 4], [-1.0, 1.0], 0.1, -1.0),
        ([1, 1, 2], [1.0, 2.0], 0.95, 2.0),
    ],
)
def test_quantile_rules(spark, counts, bounds, q, expected):
    assert quantile(spark, counts, bounds, q) == expected
