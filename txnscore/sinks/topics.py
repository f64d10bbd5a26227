"""Kafka topics. Needs the Kafka connector of the same Spark version on the classpath."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from txnscore.config import KafkaSettings
from txnscore.operators.deciding import alert_values

# Delivery settings of the record producer.
RECORD_OPTIONS = {
    "kafka.acks": "all",
    "kafka.compression.type": "gzip",
    "kafka.retries": "3",
    "kafka.retry.backoff.ms": "500",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.request.timeout.ms": "30000",
    "kafka.max.block.ms": "60000",
}


def record_options(settings: KafkaSettings) -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings.servers, "topic": settings.input_topic, **RECORD_OPTIONS}


def alert_options(settings: KafkaSettings) -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings.servers, "topic": settings.alert_topic}


def send_records(keyed: DataFrame, settings: KafkaSettings) -> None:
    keyed.write.format("kafka").options(**record_options(settings)).save()


def alert_sender(settings: KafkaSettings) -> Callable[[DataFrame, int], None]:
    """A writer for the scoring job. A failed send fails the batch; a replay sends the same alert ids again."""

    def send(alert_rows: DataFrame, batch_id: int) -> None:
        alert_values(alert_rows).write.format("kafka").options(**alert_options(settings)).save()

    return send
