"""Training, scoring and inspecting models."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from txnscore.config import FRAUD_THRESHOLD
from txnscore.operators.deciding import SCORE
from txnscore.operators.preparation import PREPARED, fit_facts, preparation
from txnscore.schemas import FEATURES, LABEL
from txnscore.workspace import shared_root


# Rows that a task of the trees has at least, and at most; the trees read all rows some hundred times.
_LEAST_ROWS, _MOST_ROWS = 25_000, 1_000_000


@dataclass(frozen=True)
class TrainingParams:
    # Number of trees, their depth, learning rate and seed.
    trees: int = 100
    depth: int = 6
    learning_rate: float = 0.1
    seed: int = 42


def training_tasks(rows: int, cores: int) -> int:
    """Tasks for so many rows: as few as small tables need, else whole rounds of all cores, so that none waits for the last."""
    if rows < cores * _LEAST_ROWS:
        return max(1, math.ceil(rows / _LEAST_ROWS))
    return cores * math.ceil(rows / (cores * _MOST_ROWS))


def train(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    params: TrainingParams = TrainingParams(),
) -> PipelineModel:
    """Boosted trees over prepared features, fraud rows weighted by the class ratio; unlabelled rows are left out.

    One scan gives all that preparation and weights need; the next is that of the trees. Its rows are dealt out evenly by one
    shuffle, which the scans of the trees share, since every pass waits for its largest task. Lineage of the boosting rounds
    is cut by checkpoints in the session's shared folder.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    known = df.where(F.col(label).isNotNull()).select(*features, label)
    facts = fit_facts(known, features, label=label)
    weighted = known.select(
        *features,
        F.col(label).cast("double").alias("target"),
        F.when(F.col(label) == 1, F.lit(facts.fraud_weight)).otherwise(F.lit(1.0)).alias("weight"),
    ).repartition(training_tasks(facts.rows, spark.sparkContext.defaultParallelism))
    assembler = VectorAssembler(inputCols=[PREPARED + name for name in features], outputCol="features")
    trees = GBTClassifier(
        labelCol="target",
        weightCol="weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        seed=params.seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[preparation(facts), assembler, trees]).fit(weighted)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds the probability of fraud; works on tables and on streams."""
    return model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias(SCORE))


def score_udf(
    df: DataFrame,
    model_factory: Callable[[], Callable[[pd.DataFrame], np.ndarray]],
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Scores with any Python model: the factory runs once per task, then sees whole Arrow batches."""

    @F.pandas_udf(DoubleType())
    def probabilities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = model_factory()
        for batch in batches:
            yield pd.Series(predict(batch), dtype="float64")

    return df.withColumn(SCORE, probabilities(F.struct(*features)))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature of the model, by name."""
    _, assembler, trees = model.stages
    names = [name.removeprefix(PREPARED) for name in assembler.getInputCols()]
    values = [float(value) for value in trees.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(names, values, strict=True)), "feature string, importance double")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)


def model_metadata(
    split: DataFrame,
    auc: DataFrame,
    label: str = LABEL,
    features: Sequence[str] = FEATURES,
    params: TrainingParams = TrainingParams(),
    threshold: float = FRAUD_THRESHOLD,
) -> DataFrame:
    """One row of facts about a trained model; ``auc`` is the one-row result of the hold-out evaluation."""
    in_train = F.col("split") == "train"
    fraud = in_train & (F.col(label) == 1)
    legitimate = in_train & (F.col(label) == 0)
    sizes = split.agg(
        F.count_if(in_train).alias("train_size"),
        F.count_if(F.col("split") == "test").alias("test_size"),
        F.round(F.avg(F.when(in_train, F.col(label))), 6).alias("fraud_rate_train"),
        F.round(F.count_if(legitimate) / F.nullif(F.count_if(fraud), F.lit(0)), 2).alias("scale_pos_weight"),
    )
    return sizes.select(
        F.round(auc.select("auc_roc").scalar(), 4).alias("auc_roc"),
        F.array(*map(F.lit, features)).alias("features"),
        F.lit(params.trees).alias("n_estimators"),
        F.lit(threshold).alias("threshold"),
        "train_size",
        "test_size",
        "fraud_rate_train",
        "scale_pos_weight",
    )
