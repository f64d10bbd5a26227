"""Training, saving, scoring and foreign models."""

import json

import pytest
from pyspark.sql import functions as F

from txnscore.operators import deciding, evaluation, preparation, training
from txnscore.plans import fixtures
from txnscore.schemas import DATASET, FEATURES, TRANSACTIONS
from txnscore.config import SinkPaths
from txnscore.sinks.tables import read_table
from txnscore.sources.dataset import read_dataset
from txnscore.sources.models import load_model, read_metadata, save_metadata, save_model
from txnscore.sources.records import record_stream
from txnscore.streaming.scoring import model_scorer, start_scoring
from txnscore.workspace import new_folder

PARAMS = training.TrainingParams(trees=8, depth=3)


@pytest.fixture(scope="module")
def dataset(spark):
    """A tenth of the rows is fraud, told apart by V1; V2 has gaps."""
    ids = spark.range(3_000).withColumn("Class", (F.col("id") % 10 == 0).cast("int"))
    noise = lambda seed: F.rand(seed) - 0.5
    columns = {name: noise(i) for i, name in enumerate(FEATURES)}
    columns["V1"] = noise(100) + F.col("Class") * 0.8
    columns["V2"] = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, float("nan")).otherwise(noise(101))
    return ids.withColumns(columns).withColumn("transaction_id", F.col("id").cast("string"))


@pytest.fixture(scope="module")
def model(dataset):
    return training.train(dataset, params=PARAMS)


def test_default_parameters():
    assert training.TrainingParams() == training.TrainingParams(trees=100, depth=6, learning_rate=0.1, seed=42)


@pytest.mark.parametrize("rows, cores, tasks", [(0, 12, 1), (800, 12, 1), (60_000, 12, 3), (480_000, 12, 12), (4_800_000, 12, 12), (28_800_000, 12, 36)])
def test_large_tables_train_in_whole_rounds_of_all_cores(rows, cores, tasks):
    assert training.training_tasks(rows, cores) == tasks


def test_passes_of_the_trees_have_even_tasks(spark, dataset, monkeypatch):
    """Rows in one task of many are dealt out, and few rows do not take a task per partition they come in."""
    seen, fit = [], training.Pipeline.fit

    def watched(pipeline, rows):
        seen.append(rows.rdd.mapPartitions(lambda some: [sum(1 for _ in some)]).collect())
        return fit(pipeline, rows)

    monkeypatch.setattr(training.Pipeline, "fit", watched)
    training.train(dataset.repartition(40), params=training.TrainingParams(trees=1, depth=1))
    monkeypatch.setattr(training, "_LEAST_ROWS", 300)
    training.train(dataset.coalesce(1), params=training.TrainingParams(trees=1, depth=1))
    cores = spark.sparkContext.defaultParallelism
    assert seen[0] == [3_000] and len(seen[1]) == min(10, cores) and max(seen[1]) - min(seen[1]) <= 1


def test_model_tells_the_classes_apart(dataset):
    split = preparation.stratified_split(dataset)
    fitted = training.train(split.where("split = 'train'"), params=PARAMS)
    row = evaluation.evaluate(training.score(split.where("split = 'test'"), fitted), "Class").first()
    assert row["auc_roc"] > 0.9 and row["recall"] > 0.7


def test_fraud_weight_raises_recall(dataset, model):
    scored = deciding.decide(training.score(dataset, model))
    row = evaluation.confusion(scored, "Class").first()
    assert row["fnr_pct"] < 25


def test_scoring_keeps_rows_columns_and_raw_values(dataset, model):
    scored = training.score(dataset, model)
    assert scored.columns == [*dataset.columns, "fraud_probability"]
    assert scored.count() == 3_000
    assert scored.where("fraud_probability is null or not fraud_probability between 0 and 1").count() == 0
    assert scored.drop("fraud_probability").exceptAll(dataset).count() == 0


def test_saved_model_scores_alike(spark, dataset, model):
    path = new_folder(spark, "model")
    save_model(model, path)
    save_model(model, path)
    again = training.score(dataset, load_model(path)).select("id", "fraud_probability")
    assert training.score(dataset, model).select("id", "fraud_probability").exceptAll(again).count() == 0


def test_unlabelled_rows_do_not_train(dataset, model):
    more = dataset.unionByName(dataset.withColumn("Class", F.lit(None).cast("int")).withColumn("V1", F.lit(9.0)))
    scores = [training.score(dataset.limit(50), m).select("fraud_probability").collect() for m in (model, training.train(more, params=PARAMS))]
    assert scores[0] == scores[1]


def test_importance_names_the_telling_feature(spark, model):
    importance = training.feature_importance(spark, model)
    assert importance.count() == 30
    top = training.top_features(importance).collect()
    assert len(top) == 10 and top[0]["feature"] == "V1"


def test_metadata_round_trip(spark, dataset):
    split = preparation.stratified_split(dataset)
    auc = spark.createDataFrame([(0.97468,)], "auc_roc double")
    path = new_folder(spark, "metadata")
    save_metadata(training.model_metadata(split, auc, params=PARAMS), path)
    row = read_metadata(spark, path).first()
    assert (row["auc_roc"], row["train_size"], row["test_size"]) == (0.9747, 2_400, 600)
    assert (row["fraud_rate_train"], row["scale_pos_weight"], row["n_estimators"]) == (0.1, 9.0, 8)
    text = json.loads(spark.read.text(path).first()[0])
    assert text["features"] == FEATURES and text["threshold"] == 0.5


def test_model_scores_a_stream(spark, sf_dir):
    fitted = training.train(fixtures.transactions(spark, sf_dir), params=training.TrainingParams(trees=3, depth=3))
    folder = new_folder(spark, "model-stream")
    sent = fixtures.records(spark, sf_dir)
    sent.repartition(2).write.parquet(f"{folder}/inbox")
    paths = SinkPaths.under(f"{folder}/tables")
    stream = record_stream(spark, f"{folder}/inbox", 1)
    query = start_scoring(stream, model_scorer(fitted), paths, f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    got = read_table(spark, paths.transactions, TRANSACTIONS).select("transaction_id", "fraud_probability")
    direct = training.score(fixtures.transactions(spark, sf_dir), fitted).select("transaction_id", "fraud_probability")
    assert got.exceptAll(direct).count() == 0 and got.count() == 1_000


def test_foreign_model_is_loaded_once_per_task(spark):
    def factory():
        import uuid

        token = uuid.uuid4().int % 1_000_003

        return lambda batch: batch["V1"] * 0 + float(token)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(0, 4_000, 1, 4).select(F.rand(1).alias("V1"), F.spark_partition_id().alias("task"))
        scored = training.score_udf(df, factory, ["V1"])
        tokens = scored.groupBy("task").agg(F.countDistinct("fraud_probability").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(tokens) == 4 and all(row["n"] == 1 for row in tokens)


def test_dataset_from_csv(spark, tmp_path):
    path = tmp_path / "data.csv"
    header = ",".join(FEATURES + ["Class"])
    path.write_text(f"{header}\n" + ",".join(["1.5"] * 30 + ["0"]) + "\n" + ",".join(["", "x"] + ["2"] * 28 + ["1"]) + "\n")
    df = read_dataset(spark, str(path))
    assert df.schema == DATASET
    rows = df.orderBy("Class").collect()
    assert (rows[0]["Amount"], rows[0]["Class"]) == (1.5, 0)
    assert rows[1]["Time"] is None and rows[1]["V1"] is None and rows[1]["V2"] == 2.0
