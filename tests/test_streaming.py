"""The scoring job on file streams."""

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from frames import message, record, records
from txnscore.config import KafkaSettings, ScoringConfig, SinkPaths
from txnscore.functions.buckets import SCORE
from txnscore.operators import deciding, histograms, parsing, rates
from txnscore.plans import fixtures
from txnscore.plans.dashboard import REPORTS
from txnscore.schemas import ALERTS, BATCH_METRICS, BATCH_SERIES, REJECTS, TRANSACTIONS
from txnscore.sinks.tables import read_table
from txnscore.sources.records import kafka_options, record_stream
from txnscore.streaming.rates import start_pane_totals, streamed_rate
from txnscore.streaming.scoring import process_batch, run_until_stopped, scored_records, start_scoring
from txnscore.workspace import new_folder


def amount_score(messages):
    """The amount in percent as probability."""
    return messages.withColumn("fraud_probability", F.col("Amount") / 100)


class Job:
    def __init__(self, spark, scorer=amount_score, **options):
        self.spark, self.scorer, self.options = spark, scorer, options
        self.root = new_folder(spark, "job")
        self.paths = SinkPaths.under(f"{self.root}/tables")

    def send(self, *rows):
        records(self.spark, list(rows)).coalesce(1).write.mode("append").parquet(f"{self.root}/inbox")

    def start(self, files=1):
        stream = record_stream(self.spark, f"{self.root}/inbox", files)
        return start_scoring(
            stream, self.scorer, self.paths, f"{self.root}/checkpoint", available_now=True, **self.options
        )

    def run(self, files=1):
        query = self.start(files)
        query.awaitTermination()
        return query

    def table(self, name, schema):
        return read_table(self.spark, getattr(self.paths, name), schema)

    def rows(self, name, schema, *cols):
        return sorted(tuple(row) for row in self.table(name, schema).select(*cols).collect())

    def everything(self):
        return {
            "transactions": self.rows("transactions", TRANSACTIONS, "transaction_id", "amount", "batch_id"),
            "alerts": self.rows("alerts", ALERTS, "alert_id", "amount", "severity", "batch_id"),
            "batch_metrics": self.rows("batch_metrics", BATCH_METRICS, "batch_id", "batch_size", "fraud_count"),
            "rejects": self.rows("rejects", REJECTS, "issue", "offset", "batch_id"),
        }


@pytest.fixture
def job(spark):
    return Job(spark)


def test_one_batch_reaches_all_sinks(job):
    job.send(
        record(1, message(1, Amount=95.0)),
        record(2, message(2, Amount=20.0)),
        record(3, "not json"),
        record(4, message(4, Amount=60.0, country="USA")),
        record(5, message(5, Amount=55.0, is_fraud_ground_truth=None)),
    )
    job.run()
    assert job.everything() == {
        "transactions": [("TXN-00000001", 95.0, 0), ("TXN-00000002", 20.0, 0), ("TXN-00000005", 55.0, 0)],
        "alerts": [("ALERT-TXN-00000001", 95.0, "CRITICAL", 0), ("ALERT-TXN-00000005", 55.0, "MEDIUM", 0)],
        "batch_metrics": [(0, 3, 2)],
        "rejects": [("long_country", 4, 0), ("malformed_json", 3, 0)],
    }
    series = job.table("batch_series", BATCH_SERIES).first()
    assert (series["batch_size"], series["fraud_count"], series["actual_count"], series["rejected_count"]) == (3, 2, 0, 2)
    assert series["score_buckets"] == [0, 0, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0]
    assert 0 < series["inference_seconds"] <= series["batch_seconds"]
    times = {row[0] for row in job.rows("transactions", TRANSACTIONS, "processing_time_ms")}
    assert list(times) == [pytest.approx(series["inference_seconds"] * 1000)]


def test_batches_follow_the_intake_limit_and_duplicates_are_stored_once(job):
    job.send(record(1, message(1, Amount=80.0)))
    job.send(record(2, message(1, Amount=90.0)), record(3, message(2, Amount=10.0)))
    job.run(files=1)
    found = job.everything()
    assert found["transactions"] == [("TXN-00000001", 80.0, 0), ("TXN-00000002", 10.0, 1)]
    # Duplicates count in metrics and alerts; only the transaction table drops them.
    assert found["batch_metrics"] == [(0, 1, 1), (1, 2, 1)]
    assert [row[1] for row in found["alerts"]] == [80.0, 90.0]


def test_restart_goes_on_where_it_stopped(job):
    job.send(record(1, message(1)))
    job.run()
    job.send(record(2, message(2)))
    job.run()
    assert [row[0] for row in job.everything()["batch_metrics"]] == [0, 1]
    assert len(job.everything()["transactions"]) == 2


def test_lost_commit_replays_the_batch_without_a_trace(job):
    job.send(record(1, message(1, Amount=80.0)), record(2, "not json"))
    job.send(record(3, message(1, Amount=70.0)), record(4, message(2, Amount=60.0)))
    job.run()
    before = job.everything()
    commits = f"{job.root}/checkpoint/commits"
    for name in (f"{commits}/1", f"{commits}/.1.crc"):
        if os.path.exists(name):
            os.remove(name)
    job.run()
    assert job.everything() == before


def test_new_checkpoint_keeps_what_is_stored(job):
    job.send(record(1, message(1, Amount=80.0)), record(2, message(2, Amount=20.0)))
    job.run()
    before = job.everything()
    job.send(record(3, message(2, Amount=90.0)), record(4, message(3, Amount=70.0)))
    stream = record_stream(job.spark, f"{job.root}/inbox", 1)
    for _ in range(2):
        again = start_scoring(stream, job.scorer, job.paths, f"{job.root}/second", available_now=True)
        again.awaitTermination()
    found, second = job.everything(), 1 << 40
    assert found["transactions"] == [*before["transactions"], ("TXN-00000003", 70.0, second + 1)]
    assert [row[0] for row in found["batch_metrics"]] == [0, second, second + 1]
    assert len(found["alerts"]) == len(before["alerts"]) + 3


def test_one_time_per_batch(spark):
    sent = []
    sender = lambda rows, batch_id: sent.extend(row["timestamp"] for row in rows.collect())
    job = Job(spark, alert_senders=(sender,))
    job.send(record(1, message(1, Amount=80.0)))
    job.run()
    stored_at = job.table("alerts", ALERTS).selectExpr("unix_micros(alerted_at) / 1e6 t").first()["t"]
    assert sent == [stored_at]
    assert job.table("transactions", TRANSACTIONS).selectExpr("unix_micros(processed_at) / 1e6 t").first()["t"] == stored_at


def test_batch_without_alerts_writes_no_alert_file(job):
    job.send(record(1, message(1, Amount=10.0)))
    job.run()
    assert not glob.glob(f"{job.root}/tables/fraud_alerts/*")


def test_same_batch_processed_twice(spark, job):
    job.send(record(1, message(1, Amount=80.0)))
    job.run()
    batch = scored_records(records(spark, [record(5, message(5, Amount=99.0)), record(6, "{")]), amount_score, ScoringConfig())
    process_batch(batch, 7, job.paths)
    before = job.everything()
    process_batch(batch, 7, job.paths)
    assert job.everything() == before
    assert before["batch_metrics"] == [(0, 1, 1), (7, 1, 1)]


def test_batch_without_sound_rows_writes_rejects_only(job):
    job.send(record(1, "not json"))
    job.run()
    assert job.everything() == {
        "transactions": [],
        "alerts": [],
        "batch_metrics": [],
        "rejects": [("malformed_json", 1, 0)],
    }


def test_empty_batch_writes_nothing(spark, job):
    job.send(record(1, message(1)))
    job.run()
    process_batch(scored_records(records(spark, []), amount_score, ScoringConfig()), 9, job.paths)
    assert not glob.glob(f"{job.root}/tables/*/9-*")


def test_failed_batch_is_not_lost(spark):
    def failing(alert_rows, batch_id):
        raise RuntimeError("topic is away")

    job = Job(spark, alert_senders=(failing,))
    job.send(record(1, message(1, Amount=80.0)))
    for attempt in (1, 2):
        with pytest.raises(StreamingQueryException):
            job.run()
        (row,) = REPORTS["failures"](spark, job.paths).collect()
        assert tuple(row) == ("alert_topic", attempt, 1, attempt - 1)
        assert all(not rows for rows in job.everything().values())
    job.options = {}
    job.run()
    assert job.everything()["transactions"] == [("TXN-00000001", 80.0, 0)]
    assert job.everything()["batch_metrics"] == [(0, 1, 1)]


def test_failing_scorer_stops_the_query(spark):
    broken = lambda messages: messages.withColumn("fraud_probability", F.raise_error(F.lit("no model")).cast("double"))
    job = Job(spark, scorer=broken)
    job.send(record(1, message(1)))
    with pytest.raises(StreamingQueryException):
        job.run()
    assert job.everything()["transactions"] == []


def test_threshold_and_senders(spark):
    sent = []
    sender = lambda rows, batch_id: sent.extend(row["value"] for row in deciding.alert_values(rows).collect())
    job = Job(spark, config=ScoringConfig(threshold=0.2), alert_senders=(sender,))
    job.send(record(1, message(1, Amount=30.0)), record(2, message(2, Amount=10.0)))
    job.run()
    assert [row[2] for row in job.everything()["alerts"]] == ["LOW"]
    assert len(sent) == 1 and '"alert_id":"ALERT-TXN-00000001"' in sent[0] and '"severity":"LOW"' in sent[0]


def test_unscored_rows_are_stored_but_not_flagged(spark):
    nan = lambda messages: messages.withColumn("fraud_probability", F.lit(float("nan")))
    job = Job(spark, scorer=nan)
    job.send(record(1, message(1)))
    job.run()
    assert job.everything()["batch_metrics"] == [(0, 1, 0)] and len(job.everything()["transactions"]) == 1


def test_trigger_runs_until_stopped(spark, job):
    job.send(record(1, message(1)))
    stream = record_stream(spark, f"{job.root}/inbox")
    query = start_scoring(
        stream, amount_score, job.paths, f"{job.root}/checkpoint", ScoringConfig(batch_interval_seconds=1)
    )
    query.processAllAvailable()
    job.send(record(2, message(2)))
    query.processAllAvailable()
    query.stop()
    run_until_stopped(query)
    assert not query.isActive and len(job.everything()["transactions"]) == 2


def test_stream_equals_batch(spark, sf_dir):
    job = Job(spark, scorer=fixtures.with_logistic_score)
    sent = fixtures.records(spark, sf_dir, defects=True)
    sent.repartition(3).write.parquet(f"{job.root}/inbox")
    job.run(files=1)
    valid, rejects = parsing.parse_messages(sent)
    decided = deciding.decide(fixtures.with_logistic_score(valid))
    columns = ["transaction_id", "amount", "fraud_probability", "is_fraud_predicted", "is_fraud_ground_truth", "country"]
    batch = deciding.transaction_records(decided, processing_ms=F.lit(0.0)).select(*columns)
    stream = job.table("transactions", TRANSACTIONS).select(*columns)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0
    assert job.table("batch_metrics", BATCH_METRICS).count() == 3
    assert job.table("rejects", REJECTS).count() == rejects.count()
    assert job.table("alerts", ALERTS).count() == deciding.alerts(decided).count()
    merged = histograms.merge_histogram_arrays(job.table("batch_series", BATCH_SERIES), "score_buckets", len(SCORE))
    direct = histograms.histogram_arrays(decided, "fraud_probability", SCORE)
    assert merged.first()["cumulative"] == direct.first()["cumulative"]


@pytest.mark.parametrize("late", [False, True])
def test_streamed_windows_equal_all_batch_windows(spark, sf_dir, late):
    folder = new_folder(spark, "windows")
    events = fixtures.read(spark, sf_dir, "events")
    # One file per third of the month; in reverse order, most rows are weeks late.
    parts = [(1, 10), (11, 20), (21, 31)]
    for first, last in reversed(parts) if late else parts:
        part = events.where(F.dayofmonth("ts").between(first, last))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/inbox")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/inbox")
    series = {"clicks": F.col("event_type") == "click"}
    query = start_pane_totals(
        stream, "ts", f"{folder}/totals", f"{folder}/checkpoint", 3600, 900, series, available_now=True
    )
    query.awaitTermination()
    got = streamed_rate(spark, f"{folder}/totals", 3600, 900, series)
    batch = rates.windowed_rate(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", 3600, 900, series)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_kafka_options():
    assert kafka_options(KafkaSettings()) == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "raw_transactions",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10000",
        "failOnDataLoss": "true",
    }
    assert kafka_options(KafkaSettings(fail_on_data_loss=False, min_partitions=64))["minPartitions"] == "64"
