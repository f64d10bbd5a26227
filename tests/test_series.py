"""Rates, counters, histograms and reports on small frames."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnscore.operators import histograms, metrics, rates, reports
from txnscore.operators.running import running_sums

START = datetime(2024, 1, 1)


def moments(spark, seconds, kind="timestamp_ntz"):
    return spark.createDataFrame([(START + timedelta(seconds=s),) for s in seconds], f"ts {kind}")


def brute_windows(seconds, window, slide):
    found = {}
    for s in seconds:
        pane = s // slide
        for k in range(window // slide):
            start = START + timedelta(seconds=(pane - k) * slide)
            found[start] = found.get(start, 0) + 1
    return found


@pytest.mark.parametrize("window, slide", [(60, 60), (60, 15), (300, 60), (10, 1)])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_windows_equal_a_dictionary(spark, window, slide, kind):
    seconds = [0, 0.5, 14, 15, 59.999, 60, 61, 100, 1_000]
    got = {row["window_start"]: row["n"] for row in rates.windowed_rate(moments(spark, seconds, kind), "ts", window, slide).collect()}
    assert got == brute_windows(seconds, window, slide)


def test_rate_is_per_second(spark):
    row = rates.windowed_rate(moments(spark, [0, 1, 2]), "ts", 60).first()
    assert row["rate"] == 3 / 60


def test_window_must_be_whole_slides(spark):
    with pytest.raises(ValueError):
        rates.windowed_rate(moments(spark, [0]), "ts", 60, 25)


def test_rows_without_time_are_in_no_window(spark):
    assert rates.windowed_rate(spark.createDataFrame([(None,)], "ts timestamp"), "ts", 60).count() == 0


@pytest.mark.parametrize("seconds, expected", [([0, 10], (2, 10.0, 0.2)), ([5], (1, 0.0, 0.0)), ([], (0, None, 0.0))])
def test_achieved_rate(spark, seconds, expected):
    assert tuple(rates.achieved_rate(moments(spark, seconds), "ts").first()) == expected


@pytest.mark.parametrize("block", [1, 3, 7, 100])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sums_for_any_block_size(spark, block, inclusive):
    df = spark.range(50).withColumn("x", (F.col("id") * 7 % 5).cast("long"))
    out = running_sums(df, F.floor(F.col("id") / block), "id", {"s": "x"}, inclusive, overall={"all_x": "x"})
    values = [i * 7 % 5 for i in range(50)]
    rows = out.orderBy("id").collect()
    assert [r["s"] for r in rows] == [sum(values[: i + inclusive]) for i in range(50)]
    assert {r["all_x"] for r in rows} == {sum(values)} and out.columns == ["id", "x", "all_x", "s"]


def batches(spark, n):
    rows = [(i, 100 + i, i % 4, i % 4 / (100 + i), float(i), START + timedelta(seconds=5 * i)) for i in range(n)]
    kinds = "batch_id bigint, batch_size bigint, fraud_count bigint, fraud_rate double, processing_ms double, processed_at timestamp"
    return spark.createDataFrame(rows, kinds)


def test_counters_over_gaps(spark):
    some = batches(spark, 40).where("batch_id % 3 != 1")
    rows = metrics.running_counters(some, batches_per_block=4).orderBy("batch_id").collect()
    total = 0
    for row in rows:
        total += 100 + row["batch_id"]
        assert row["processed_total"] == total
    counted = metrics.batch_count_series(some, batches_per_block=4).orderBy("batch_id").collect()
    assert [row["batches_total"] for row in counted] == list(range(1, len(rows) + 1))


def test_latest_rate(spark):
    assert metrics.latest_rate(batches(spark, 4)).first()[0] == pytest.approx(300 / 103)
    assert metrics.latest_rate(batches(spark, 4).limit(0)).first()[0] is None


def test_batch_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "is_fraud_predicted boolean")
    assert tuple(metrics.batch_stats(empty).first()) == (0, 0, 0.0)


def test_recent_batches(spark):
    rows = reports.recent_batches(batches(spark, 25)).collect()
    assert [row["batch_id"] for row in rows] == list(range(24, 14, -1))
    assert rows[1]["fraud_pct"] == Decimal("2.439") and rows[1]["ms"] == Decimal("23")


def test_recent_transactions_break_ties_by_id(spark):
    rows = [(f"T{i:02d}", START, float(i), 0.12345, True, "US") for i in range(12)]
    kinds = "transaction_id string, processed_at timestamp, amount double, fraud_probability double, is_fraud_predicted boolean, country string"
    top = reports.recent_transactions(spark.createDataFrame(rows, kinds)).collect()
    assert [row["transaction_id"] for row in top] == [f"T{i:02d}" for i in range(11, 1, -1)]
    assert top[0]["score"] == Decimal("0.1235") and top[0]["amount"] == Decimal("11.00")


def test_summary_of_nothing(spark):
    kinds = "is_fraud_predicted boolean, is_fraud_ground_truth int, fraud_probability double, processing_time_ms double"
    assert tuple(reports.fraud_summary(spark.createDataFrame([], kinds)).first()) == (0, None, None, None, None)


def test_class_profile_counts_unlabelled_rows_in_the_total(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,)], "Class int")
    assert tuple(reports.class_profile(df).first()) == (4, 1, 3, 75.0, 25.0)


def test_histogram_of_nothing_is_complete(spark):
    rows = histograms.bucket_histogram(spark.createDataFrame([], "x double"), "x", [0.1, 1.0]).collect()
    assert [tuple(row) for row in rows] == [(0, "0.1", 0, 0), (1, "1.0", 0, 0), (2, "+Inf", 0, 0)]
    assert histograms.histogram_quantile(spark.createDataFrame([], "x double"), "x", [0.1], [0.5]).first()["p50"] is None


def test_histogram_per_group(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.5), ("b", 7.0), ("b", None)], "g string, x double")
    rows = histograms.bucket_histogram(df, "x", [0.1, 1.0], "g").orderBy("g", "bucket").collect()
    assert [(r["g"], r["bucket_count"], r["cumulative_count"]) for r in rows] == [
        ("a", 1, 1), ("a", 1, 2), ("a", 0, 2), ("b", 0, 0), ("b", 0, 0), ("b", 1, 1),
    ]


def test_differences_start_at_the_first_positive_bound(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.15,), (1.0,), (2.0,)], "x double")
    arrays = histograms.histogram_arrays(df, "x", [0.0, 0.1, 0.2, 1.0])
    assert [tuple(row) for row in histograms.bucket_differences(arrays, [0.0, 0.1, 0.2, 1.0]).collect()] == [
        ("< 0.1", 2), ("0.1-0.2", 1), ("0.2-1.0", 1),
    ]
