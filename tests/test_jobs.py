"""The programs one after the other, as a user runs them, and row numbering."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnscore.config import KafkaSettings, SinkPaths
from txnscore.jobs import parser, run, scoring_settings
from txnscore.operators.numbering import with_row_numbers
from txnscore.plans import fixtures
from txnscore.plans.dashboard import REPORTS
from txnscore.schemas import COMPONENTS, KAFKA_RECORD, TRANSACTIONS
from txnscore.schemas import stored as stored_schema
from txnscore.sinks.tables import read_table, store_of
from txnscore.sources.models import read_metadata
from txnscore.workspace import new_folder


@pytest.fixture(scope="module")
def work(spark, sf_dir):
    folder = new_folder(spark, "programs")
    columns = ["Time", *COMPONENTS, "Amount", "Class"]
    data = fixtures.transactions(spark, sf_dir).select(*columns)
    data.repartition(4).write.csv(f"{folder}/data", header=True)
    tables, inbox, model = (f"{folder}/{name}" for name in ("tables", "inbox", "model"))
    run(["train", "--data", f"{folder}/data", "--model", model, "--trees", "4", "--depth", "3"], spark)
    run(["produce", "--data", f"{folder}/data", "--records", inbox, "--tables", tables], spark)
    score = ["score", "--model", model, "--tables", tables, "--records", inbox, "--once"]
    run([*score, "--checkpoint", f"{folder}/checkpoint"], spark)
    return folder


def test_metadata_is_saved(spark, work):
    row = read_metadata(spark, f"{work}/model/metadata").first()
    assert (row["train_size"], row["test_size"], row["n_estimators"]) == (800, 200, 4)


def test_topic_options_reach_the_settings():
    given = ["score", "--model", "m", "--tables", "t", "--checkpoint", "c", "--servers", "b:9092"]
    assert scoring_settings(parser().parse_args(given)) == KafkaSettings(servers="b:9092")
    more = ["--topic", "in", "--alert-topic", "out", "--intake", "5000000", "--min-partitions", "400", "--offsets", "earliest"]
    assert scoring_settings(parser().parse_args([*given, *more, "--ignore-data-loss"])) == KafkaSettings(
        "b:9092", "in", "out", 5_000_000, "earliest", False, 400
    )


def test_records_are_numbered_from_one(spark, work):
    sent = spark.read.schema(KAFKA_RECORD).parquet(f"{work}/inbox")
    keys = sorted(int(bytes(row["key"])) for row in sent.select("key").collect())
    assert keys == list(range(1, 1_001))
    ids = sent.select(F.get_json_object(F.col("value").cast("string"), "$.transaction_id").alias("i"))
    assert ids.agg(F.min("i"), F.max("i")).first()[:] == ("TXN-00000001", "TXN-00001000")


def test_every_record_is_scored(spark, work):
    stored = read_table(spark, f"{work}/tables/transactions", TRANSACTIONS)
    assert stored.count() == 1_000
    assert stored.where("fraud_probability is null or merchant_id not rlike '^MERCHANT-[0-9]{4}$'").count() == 0
    assert stored.select("country").distinct().count() == 10


def test_reports_show_rows(spark, work, capsys):
    for name in REPORTS:
        run(["report", name, "--tables", f"{work}/tables"], spark)
    assert "fraud_probability" not in capsys.readouterr().err


def test_reports_agree_with_the_tables(spark, work):
    paths = SinkPaths.under(f"{work}/tables")
    report = {name: query(spark, paths) for name, query in REPORTS.items()}
    flagged = read_table(spark, paths.transactions, TRANSACTIONS).where("is_fraud_predicted").count()
    assert tuple(report["health"].first()) == (1_000, flagged)
    assert report["fraud"].first()["detected"] == flagged
    assert report["counters"].orderBy(F.col("batch_id").desc()).first()["processed_total"] == 1_000
    assert report["scores"].where("le = '+Inf'").first()["cumulative_count"] == 1_000
    assert report["score-ranges"].agg(F.sum("n_rows")).first()[0] == 1_000
    assert report["throughput"].selectExpr("round(sum(processed_per_second) * 60)").first()[0] == 1_000
    assert report["throughput"].selectExpr("round(sum(sent_per_second) * 60)").first()[0] == 1_000
    assert report["sent"].first()["sent_total"] == 1_000 and report["send-times"].where("le = '+Inf'").count() == 1
    frauds = read_table(spark, paths.transactions, TRANSACTIONS).where("is_fraud_ground_truth = 1").count()
    assert report["sent"].first()["fraud_sent_total"] == frauds
    assert report["fraud-rates"].selectExpr("round(sum(detected_per_second) * 60)").first()[0] == flagged
    assert report["transactions"].count() == 10
    assert report["issues"].count() == 0
    assert report["latency"].first()["p95"] > 0


def test_reports_over_new_tables(spark):
    folder = new_folder(spark, "empty")
    for name in REPORTS:
        run(["report", name, "--tables", folder], spark)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_row_numbers_are_consecutive(spark, partitions):
    df = with_row_numbers(spark.range(0, 1_000, 1, partitions), "number")
    assert df.where("number <> id + 1").count() == 0 and df.count() == 1_000


def test_row_numbers_over_empty_partitions(spark):
    df = with_row_numbers(spark.range(0, 100, 1, 10).where("id % 40 > 30"), "number")
    rows = [row["number"] for row in df.orderBy("id").collect()]
    assert rows == list(range(1, len(rows) + 1)) and len(rows) > 10


def test_row_numbers_of_nothing(spark):
    assert with_row_numbers(spark.range(0), "number").count() == 0


def store_rows(spark, paths, rows):
    """Rows of several batches as one folder."""
    store = store_of(spark, paths.transactions)
    frame = spark.createDataFrame(rows, stored_schema(TRANSACTIONS))
    store.commit(0, [store.stage("transactions", frame.drop("batch_id"), 0, len(rows))])


@pytest.mark.parametrize("sizes", [[3], [12, 1, 2], [2, 20], [4, 0, 0, 0, 0, 0, 0, 0, 0, 1], [1] * 30])
def test_last_transactions_over_batches_of_any_size(spark, sizes):
    paths = SinkPaths.under(new_folder(spark, "latest"))
    rows = []
    for batch_id, size in enumerate(sizes):
        moment = datetime(2024, 1, 1) + timedelta(seconds=5 * batch_id)
        rows += [(f"B{batch_id:02d}-{i:02d}", moment, 1.0, 0.5, True, 0, "M", "1", "US", 1.0, batch_id) for i in range(size)]
    store_rows(spark, paths, rows)
    got = [row["transaction_id"] for row in REPORTS["transactions"](spark, paths).collect()]
    assert got == sorted((row[0] for row in rows), reverse=True)[:10]


def test_last_transactions_go_by_time_not_by_batch(spark):
    paths = SinkPaths.under(new_folder(spark, "latest"))
    rows = [(f"B{b}", datetime(2024, 1, 9 - b), 1.0, 0.5, True, 0, "M", "1", "US", 1.0, b) for b in range(8)]
    store_rows(spark, paths, rows)
    frame = REPORTS["transactions"](spark, paths)
    assert [row["transaction_id"] for row in frame.collect()] == [f"B{b}" for b in range(8)]
    assert "TakeOrderedAndProject" in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("packed", ["1m", "2k"])
def test_row_numbers_follow_the_paths_of_files(spark, packed):
    folder = new_folder(spark, "numbers")
    for name, rows in (("a", 5), ("b", 2_000), ("c", 40)):
        frame = spark.range(rows).selectExpr(f"concat('{name}', lpad(id, 5, '0')) AS line")
        frame.coalesce(1).write.text(f"{folder}/{name}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", packed)
    try:
        numbered = with_row_numbers(spark.read.text(f"{folder}/*"), "number").orderBy("number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    lines = [row["value"] for row in numbered]
    assert lines == sorted(lines) and [row["number"] for row in numbered] == list(range(1, 2_046))
