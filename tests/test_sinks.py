"""Tables that survive replays."""

import glob
import random

import duckdb
import pytest
from pyspark.errors import AnalysisException

from frames import stored
from txnscore.config import KafkaSettings, SinkPaths
from txnscore.schemas import BATCH_METRICS, TRANSACTIONS
from txnscore.sinks import store as store_module
from txnscore.sinks import tables, topics
from txnscore.sinks.database import append_to_database, merge_into_database, merge_text
from txnscore.sinks.store import FAN, ForeignWriterError, Piece
from txnscore.sources.records import kafka_stream
from txnscore.workspace import new_folder


@pytest.fixture
def path(spark):
    return SinkPaths.under(new_folder(spark, "sinks")).transactions


def content(spark, path):
    rows = tables.read_table(spark, path, TRANSACTIONS).select("transaction_id", "amount", "batch_id").collect()
    return sorted(tuple(row) for row in rows)


def test_first_of_equal_keys_wins(spark, path):
    rows = [("A", 3.0, 1, 0), ("A", 1.0, 0, 5), ("A", 2.0, 0, 9), ("B", 4.0, 2, 2)]
    tables.insert_if_absent(stored(spark, rows), path, 0)
    assert content(spark, path) == [("A", 1.0, 0), ("B", 4.0, 0)]


def test_keys_of_earlier_batches_stay(spark, path):
    tables.insert_if_absent(stored(spark, [("A", 1.0, 0, 0), ("B", 2.0, 0, 1)]), path, 0)
    tables.insert_if_absent(stored(spark, [("B", 9.0, 0, 2), ("C", 3.0, 0, 3)]), path, 1)
    assert content(spark, path) == [("A", 1.0, 0), ("B", 2.0, 0), ("C", 3.0, 1)]


def test_replay_changes_nothing(spark, path):
    first, second = [("A", 1.0, 0, 0)], [("A", 9.0, 0, 1), ("B", 2.0, 0, 2)]
    tables.insert_if_absent(stored(spark, first), path, 0)
    for _ in range(3):
        tables.insert_if_absent(stored(spark, second), path, 1)
        assert content(spark, path) == [("A", 1.0, 0), ("B", 2.0, 1)]


def test_replay_of_a_batch_of_duplicates(spark, path):
    tables.insert_if_absent(stored(spark, [("A", 1.0, 0, 0)]), path, 0)
    for _ in range(2):
        tables.insert_if_absent(stored(spark, [("A", 2.0, 0, 1)]), path, 1)
    assert content(spark, path) == [("A", 1.0, 0)]


def test_empty_batch(spark, path):
    tables.insert_if_absent(stored(spark, []), path, 0)
    assert content(spark, path) == []


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_small_and_large_batches_agree_with_a_dictionary(spark, path, monkeypatch, limit):
    monkeypatch.setattr(tables, "BROADCAST_KEYS", limit)
    rng = random.Random(limit)
    expected = {}
    for batch_id in range(3):
        rows = [(f"K{rng.randrange(60):02d}", float(i), i % 3, 100 * batch_id + i) for i in range(50)]
        for name, amount, _, _ in sorted(rows, key=lambda row: row[2:]):
            expected.setdefault(name, (amount, batch_id))
        tables.insert_if_absent(stored(spark, rows), path, batch_id)
    assert content(spark, path) == sorted((name, *rest) for name, rest in expected.items())


def test_one_key_with_a_third_of_the_rows(spark, path):
    rows = [("HOT", float(i), 0, i) for i in range(1_000)] + [(f"K{i}", 1.0, 1, i) for i in range(2_000)]
    tables.insert_if_absent(stored(spark, rows).repartition(8), path, 0)
    found = content(spark, path)
    assert len(found) == 2_001 and ("HOT", 0.0, 0) in found


def test_copies_meet_before_the_shuffle(spark):
    plan = tables.first_per_key(stored(spark, []), "transaction_id", ("partition", "offset"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text and "HashAggregate" in text and "SortAggregate" not in text


def test_stored_table_is_not_shuffled_for_a_small_batch(spark, path):
    first = stored(spark, [("A", 1.0, 0, 0)])
    tables.insert_if_absent(stored(spark, [("B", 1.0, 0, 0)]), path, 0)
    others = tables.read_table(spark, path, TRANSACTIONS)
    plan = tables.absent_rows(first, others, "transaction_id", ("A", "A"), 1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("LeftSemi") : text.index("FileScan")]
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in scan
    assert "GreaterThanOrEqual(transaction_id,A)" in text and "ReadSchema: struct<transaction_id:string>" in text


def test_rows_of_a_batch_replace_themselves(spark):
    path = SinkPaths.under(new_folder(spark, "sinks")).batch_metrics
    for batch_id, size, ms in ((3, 10, 5.0), (3, 10, 7.0), (4, 0, 1.0)):
        row = tables.batch_row(spark, BATCH_METRICS, batch_size=size, fraud_count=2, processing_ms=ms)
        tables.write_batch(row, path, batch_id, 1)
    rows = tables.read_table(spark, path, BATCH_METRICS).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["batch_size"], r["processing_ms"]) for r in rows] == [(3, 10, 7.0), (4, 0, 1.0)]
    assert all(row["processed_at"] is not None and row["fraud_rate"] is None for row in rows)


def test_alert_table_shape(spark):
    schema = "alert_id string, transaction_id string, timestamp double, fraud_probability double, amount double, "
    schema += "merchant_id string, country string, card_last_four string, severity string"
    rows = [("ALERT-A", "A", 1704110400.25, 0.9, 5.0, "M", "US", "1234", "CRITICAL")]
    row = tables.alert_table(spark.createDataFrame(rows, schema)).first()
    assert str(row["alerted_at"]) == "2024-01-01 12:00:00.250000" and row["severity"] == "CRITICAL"


def _files(spark, path):
    """Folders and files that hold what is read."""
    store = tables.store_of(spark, path)
    pieces = store.pieces(path.rsplit("/", 1)[1])
    return pieces, [name for piece in pieces for name in glob.glob(f"{piece.folder}/*.parquet")]


def test_nothing_shows_before_the_commit(spark, path):
    """A job that dies between writing and committing leaves no trace; the replay shows all."""
    paths = SinkPaths.under(path.rsplit("/", 1)[0])
    tables.insert_if_absent(stored(spark, [("A", 1.0, 0, 0)]), path, 0)
    store = tables.store_of(spark, path)
    pieces = [
        tables.stage_absent(store, stored(spark, [("A", 9.0, 0, 1), ("B", 2.0, 0, 2)]), path, 1),
        store.stage("batch_metrics", tables.batch_row(spark, BATCH_METRICS, batch_size=2), 1, 1),
    ]
    assert content(spark, path) == [("A", 1.0, 0)]
    assert tables.read_table(spark, paths.batch_metrics, BATCH_METRICS).isEmpty()
    store.commit(1, pieces)
    assert content(spark, path) == [("A", 1.0, 0), ("B", 2.0, 1)]
    assert tables.read_table(spark, paths.batch_metrics, BATCH_METRICS).count() == 1


def test_an_incomplete_list_is_not_read(spark, path):
    tables.insert_if_absent(stored(spark, [("A", 1.0, 0, 0)]), path, 0)
    lists = f"{path.rsplit('/', 1)[0]}/lists"
    broken = spark.createDataFrame([(2, "x", 5, "transactions", "/nowhere", 0, 1, 1)], "version long, writer string, entries long, table string, folder string, level int, batch long, rows long")
    broken.write.mode("overwrite").json(f"{lists}/place=2")
    assert content(spark, path) == [("A", 1.0, 0)]


def test_thousands_of_batches_become_few_folders(spark, path):
    """2,000 stored batches; the next one reads only folders whose keys it may share."""
    root, n = path.rsplit("/", 1)[0], 2_000
    rows = spark.range(n * 3).selectExpr(
        "format_string('K%08d', id) transaction_id", "cast(id as double) amount", "id div 3 batch_id", "id div 3 part"
    )
    every = [f"cast(null as {f.dataType.simpleString()}) {f.name}" for f in TRANSACTIONS.fields if f.name not in ("transaction_id", "amount")]
    whole = rows.selectExpr("transaction_id", "amount", *every, "batch_id", "part").select(*TRANSACTIONS.fieldNames(), "batch_id", "part")
    whole.repartition(8, "part").write.partitionBy("part").parquet(f"{root}/transactions/old")
    store = tables.store_of(spark, path)
    store._change(lambda _: [
        Piece("transactions", f"{root}/transactions/old/part={k}", 0, k, 3, f"K{3 * k:08d}", f"K{3 * k + 2:08d}") for k in range(n)
    ])
    store.compact(tables.schemas(SinkPaths.under(root)))
    pieces, files = _files(spark, path)
    assert len(pieces) <= 3 * FAN and len(files) <= 3 * FAN and sum(piece.rows for piece in pieces) == 3 * n
    back = tables.read_table(spark, path, TRANSACTIONS)
    assert back.count() == 3 * n and back.select("transaction_id").distinct().count() == 3 * n
    assert back.where("amount <> cast(substr(transaction_id, 2) as double) or batch_id <> cast(amount as bigint) div 3").isEmpty()
    touched = [piece for piece in pieces if piece.may_hold(("K00005995", "K00006010"))]
    assert len(touched) <= 3
    store = tables.store_of(spark, path)
    store.commit(n, [tables.stage_absent(store, stored(spark, [("K00005999", 0.0, 0, 0), ("K00006000", 6000.0, 0, 1), ("K00000000", 0.0, 0, 2)]), path, n)])
    assert tables.read_table(spark, path, TRANSACTIONS).count() == 3 * n + 1


def test_old_lists_and_merged_folders_go(spark, path, monkeypatch):
    monkeypatch.setattr(store_module, "FAN", 3)
    monkeypatch.setattr(store_module, "KEPT_LISTS", 4)
    store = tables.store_of(spark, path)
    for k in range(12):
        piece = tables.stage_absent(store, stored(spark, [(f"K{k}", float(k), 0, k), ("K0", 9.0, 1, k)]), path, k)
        store.commit(k, [piece])
        store.compact(tables.schemas(SinkPaths.under(path.rsplit("/", 1)[0])))
    assert content(spark, path) == sorted((f"K{k}", float(k), k) for k in range(12))
    pieces, _ = _files(spark, path)
    assert len(glob.glob(f"{path.rsplit('/', 1)[0]}/lists/place=*")) == 4
    assert len(pieces) < 7 and len(glob.glob(f"{path}/*")) < 14
    # The newest batch of a run stays replayable.
    store.commit(11, [tables.stage_absent(store, stored(spark, [("K11", 5.0, 0, 0)]), path, 11)])
    assert ("K11", 5.0, 11) in content(spark, path) and len(content(spark, path)) == 12


def test_two_writers_are_told_apart(spark, path):
    one, other = tables.store_of(spark, path), tables.store_of(spark, path)
    one.commit(0, [one.stage("transactions", stored(spark, [("A", 1.0, 0, 0)]).select(*TRANSACTIONS.fieldNames()), 0, 1)])
    other.commit(1, [])
    with pytest.raises(ForeignWriterError):
        one.commit(2, [])
    assert content(spark, path) == [("A", 1.0, 0)]


def test_run_numbers(spark, path):
    root = path.rsplit("/", 1)[0]
    store = tables.store_of(spark, path)
    assert [store.run_number(f"{root}/{name}") for name in ("c1", "c2", "c1", "c3", "c2")] == [0, 1, 0, 2, 1]
    assert store.pieces() == []


def test_topic_options():
    settings = KafkaSettings(servers="broker:9092")
    assert topics.record_options(settings)["topic"] == "raw_transactions"
    assert topics.record_options(settings)["kafka.acks"] == "all"
    assert topics.record_options(settings)["kafka.compression.type"] == "gzip"
    assert topics.alert_options(settings) == {"kafka.bootstrap.servers": "broker:9092", "topic": "fraud_alerts"}


def test_topics_ask_for_the_connector(spark):
    settings = KafkaSettings()
    rows = spark.createDataFrame([(b"1", b"{}")], "key binary, value binary")
    for use in (
        lambda: topics.send_records(rows, settings),
        lambda: topics.alert_sender(settings)(rows, 0),
        lambda: kafka_stream(spark, settings),
    ):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            use()


def test_merge_text():
    connection = duckdb.connect()
    connection.execute("CREATE TABLE txn (transaction_id VARCHAR PRIMARY KEY, amount DOUBLE)")
    connection.execute("CREATE TABLE staged (transaction_id VARCHAR, amount DOUBLE)")
    connection.execute("INSERT INTO txn VALUES ('A', 1)")
    connection.execute("INSERT INTO staged VALUES ('A', 9), ('B', 2)")
    for _ in range(2):
        connection.execute(merge_text("txn", "staged", ["transaction_id", "amount"], "transaction_id"))
    assert connection.execute("SELECT * FROM txn ORDER BY 1").fetchall() == [("A", 1.0), ("B", 2.0)]


def test_database_in_memory(spark):
    url = "jdbc:derby:memory:txnscore;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    append_to_database(stored(spark, [(f"K{i}", float(i), 0, i) for i in range(10)]).drop("offset"), url, "txn", driver)
    back = spark.read.format("jdbc").options(url=url, dbtable="txn", **driver).load()
    assert back.count() == 10 and back.selectExpr("sum(amount)").first()[0] == 45.0


def test_batches_are_merged_into_a_database_once(spark):
    """A replayed batch, one that failed while merging and one with known keys, on a database in this process."""
    url, driver = "jdbc:derby:memory:merged;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "transaction_id string, amount double")
    read = lambda: sorted(tuple(r) for r in spark.read.format("jdbc").options(url=url, dbtable="txns", **driver).load().collect())
    types = "transaction_id VARCHAR(20)"
    append_to_database(rows(), url, "txns", {**driver, "createTableColumnTypes": types})
    merge = lambda frame, batch_id: merge_into_database(frame, url, "txns", "transaction_id", batch_id, driver, types)
    merge(rows(("A", 1.0), ("B", 2.0)), 0)
    merge(rows(("B", 9.0), ("C", 3.0)), 1)
    assert read() == [("A", 1.0), ("B", 2.0), ("C", 3.0)]
    merge(rows(("D", 4.0)), 1)
    assert len(read()) == 3
    with pytest.raises(Exception, match="(?i)no_such"):
        merge(rows(("E", 5.0)).withColumnRenamed("amount", "no_such"), 2)
    assert len(read()) == 3
    merge(rows(("E", 5.0)), 2)
    assert read()[-1] == ("E", 5.0)
