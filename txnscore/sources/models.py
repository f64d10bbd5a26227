"""Saved models and the facts stored next to them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model: PipelineModel, path: str) -> None:
    """Preparation and classifier go into one folder, so serving cannot mix two versions."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_metadata(metadata: DataFrame, path: str) -> None:
    """One JSON row."""
    metadata.coalesce(1).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "auc_roc double, features array<string>, n_estimators int, threshold double, train_size long, "
        "test_size long, fraud_rate_train double, scale_pos_weight double"
    )
    return spark.read.schema(schema).json(path)
