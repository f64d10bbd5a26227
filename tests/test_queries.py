"""Every registered query against its SQL twin."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from compare import connect, differences
from txnscore.operators import preparation, training
from txnscore.plans import fixtures, queries
from txnscore.plans.oracles import ORACLES
from txnscore.plans.queries import QUERIES, _trained
from txnscore.workspace import new_folder


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert differences(entry_point.queries()[name](spark, sf_dir), connection, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_a_model_that_learns_nothing_is_found_out(spark, sf_dir, connection, monkeypatch):
    """The model queries must not come out the same when every score is one half."""
    def untrained(df, model):
        return df.withColumn("fraud_probability", F.lit(0.5))

    monkeypatch.setattr(training, "score", untrained)
    even = spark.createDataFrame([(f"V{k}", 1 / 30) for k in range(1, 31)], "feature string, importance double")
    monkeypatch.setattr(training, "feature_importance", lambda spark, model: even)
    for name in ("train_eval", "model_metadata", "score_gbt", "feature_importance"):
        assert differences(entry_point.queries()[name](spark, sf_dir), connection, ORACLES[name]) != []


def test_every_transaction_is_scored_after_saving(spark, monkeypatch):
    folder = new_folder(spark, "tables")
    event = ["id AS event_id", "timestamp_ntz'2024-01-01' AS ts", "id AS user_id", "CAST(id % 9 AS DOUBLE) AS value"]
    spark.range(90).selectExpr(*event).write.parquet(f"{folder}/events.parquet")
    vector = "transform(sequence(1, 32), k -> CAST(sin(id * k) AS FLOAT)) AS embedding"
    spark.range(20).selectExpr("id AS vec_id", vector, "CAST(id % 5 AS INT) AS label").write.parquet(f"{folder}/embeddings.parquet")

    def small(spark, sf_dir):
        planted = fixtures.decided(spark, sf_dir).withColumn("Class", F.col("is_fraud_predicted").cast("int"))
        split = preparation.hash_split(planted.drop("fraud_probability", "is_fraud_predicted"), "vec_id")
        return training.train(split, params=training.TrainingParams(trees=2, depth=2)), split

    monkeypatch.setattr(queries, "_trained", small)
    rows = QUERIES["score_gbt"](spark, folder).collect()
    assert {row["transaction_id"] for row in rows} == {f"TXN-{k:08d}" for k in range(90)} and len(rows) == 90
    assert all(row["score_sound"] and row["flag_sound"] and row["largest_difference"] == 0 for row in rows)
    assert sum({row["Class"]: row["n_rows"] for row in rows}.values()) == 90


def test_a_model_that_loses_trees_when_saved_is_found_out(spark, monkeypatch):
    """Scores before saving are those of the fitted model, not of one that was loaded, too."""
    folder = new_folder(spark, "tables")
    event = ["id AS event_id", "timestamp_ntz'2024-01-01' AS ts", "id AS user_id", "CAST(id % 9 AS DOUBLE) AS value"]
    spark.range(90).selectExpr(*event).write.parquet(f"{folder}/events.parquet")
    vector = "transform(sequence(1, 32), k -> CAST(sin(id * k) AS FLOAT)) AS embedding"
    spark.range(20).selectExpr("id AS vec_id", vector, "CAST(id % 5 AS INT) AS label").write.parquet(f"{folder}/embeddings.parquet")

    train, load, fewer = training.train, queries.load_model, new_folder(spark, "model")
    labelled = fixtures.decided(spark, folder).withColumn("Class", F.col("is_fraud_predicted").cast("int"))
    queries.save_model(train(labelled, params=training.TrainingParams(trees=1, depth=2)), fewer)
    monkeypatch.setattr(training, "train", lambda df: train(df, params=training.TrainingParams(trees=3, depth=2)))
    assert {row["largest_difference"] for row in QUERIES["score_gbt"](spark, folder).collect()} == {0.0}
    monkeypatch.setattr(queries, "_FITTED", {})
    monkeypatch.setattr(queries, "load_model", lambda path: load(fewer))
    rows = QUERIES["score_gbt"](spark, folder).collect()
    assert len(rows) == 90 and all(row["largest_difference"] > 0.01 for row in rows)


def test_top_features(spark, sf_dir):
    model, _ = _trained(spark, sf_dir)
    rows = training.top_features(training.feature_importance(spark, model)).collect()
    values = [row["importance"] for row in rows]
    assert len(rows) == 10 and values == sorted(values, reverse=True) and 0 < sum(values) <= 1 + 1e-9


def test_streamed_rate_of_a_folder_table(spark, sf_dir, connection):
    folder = new_folder(spark, "tables")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    found = entry_point.queries()["stream_windowed_rate"](spark, folder)
    assert differences(found, connection, ORACLES["stream_windowed_rate"]) == []
