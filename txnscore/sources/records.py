"""Streams of Kafka-shaped records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscore.config import KafkaSettings
from txnscore.schemas import KAFKA_RECORD

# Files of records that make up one batch, so that a backlog does not become a single batch.
FILES_PER_TRIGGER = 64


def kafka_options(settings: KafkaSettings) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.servers,
        "subscribe": settings.input_topic,
        "startingOffsets": settings.starting_offsets,
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }
    if settings.min_partitions:
        options["minPartitions"] = str(settings.min_partitions)
    return options


def kafka_stream(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    """One topic as a stream. Needs the Kafka connector of the same Spark version on the classpath.

    ``starting_offsets`` counts only for a new checkpoint. Losing data stops the query unless
    ``fail_on_data_loss`` is turned off.
    """
    return spark.readStream.format("kafka").options(**kafka_options(settings)).load()


def record_stream(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Parquet files of Kafka-shaped records as a stream, oldest file first, so many files in a batch."""
    reader = spark.readStream.schema(KAFKA_RECORD).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
