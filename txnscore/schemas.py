"""Row shapes of the messages, the Kafka records, the dataset and the sink tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The component columns, the label column and the training order of features.
COMPONENTS = [f"V{i}" for i in range(1, 29)]
LABEL = "Class"
FEATURES = ["Time", *COMPONENTS, "Amount"]
SCALED_FEATURES = ["Time", "Amount"]

# The countries a message may name.
COUNTRIES = ["US", "UK", "FR", "DE", "ES", "IT", "BR", "AU", "CA", "JP"]

# Longest text each column of the stored tables takes.
TEXT_LIMITS = {"transaction_id": 20, "merchant_id": 20, "card_last_four": 4, "country": 2}


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


DATASET = StructType(
    [StructField(name, DoubleType(), True) for name in FEATURES] + [StructField(LABEL, IntegerType(), True)]
)

KAFKA_RECORD = _struct(
    key=BinaryType(),
    value=BinaryType(),
    topic=StringType(),
    partition=IntegerType(),
    offset=LongType(),
    timestamp=TimestampType(),
)

# The shapes of messages and tables from here on.
MESSAGE = _struct(
    transaction_id=StringType(),
    timestamp=DoubleType(),
    timestamp_iso=StringType(),
    Time=DoubleType(),
    Amount=DoubleType(),
    **{name: DoubleType() for name in COMPONENTS},
    is_fraud_ground_truth=IntegerType(),
    merchant_id=StringType(),
    card_last_four=StringType(),
    country=StringType(),
)

TRANSACTIONS = _struct(
    transaction_id=StringType(),
    processed_at=TimestampType(),
    amount=DoubleType(),
    fraud_probability=DoubleType(),
    is_fraud_predicted=BooleanType(),
    is_fraud_ground_truth=IntegerType(),
    merchant_id=StringType(),
    card_last_four=StringType(),
    country=StringType(),
    processing_time_ms=DoubleType(),
)

ALERTS = _struct(
    alert_id=StringType(),
    transaction_id=StringType(),
    alerted_at=TimestampType(),
    fraud_probability=DoubleType(),
    amount=DoubleType(),
    merchant_id=StringType(),
    country=StringType(),
    card_last_four=StringType(),
    severity=StringType(),
)

BATCH_METRICS = _struct(
    processed_at=TimestampType(),
    batch_size=LongType(),
    fraud_count=LongType(),
    fraud_rate=DoubleType(),
    processing_ms=DoubleType(),
)

BATCH_SERIES = _struct(
    processed_at=TimestampType(),
    batch_size=LongType(),
    fraud_count=LongType(),
    actual_count=LongType(),
    rejected_count=LongType(),
    inference_seconds=DoubleType(),
    batch_seconds=DoubleType(),
    score_buckets=ArrayType(LongType()),
)

SENT = _struct(
    processed_at=TimestampType(),
    batch_size=LongType(),
    actual_count=LongType(),
    send_seconds=DoubleType(),
)

REJECTS = _struct(
    issue=StringType(),
    partition=IntegerType(),
    offset=LongType(),
    value=StringType(),
)

FAILURES = _struct(
    processed_at=TimestampType(),
    failed_batch=LongType(),
    sink=StringType(),
    error=StringType(),
)

BATCH_ID = "batch_id"


def stored(table: StructType) -> StructType:
    """The read shape of a sink table: its columns and the folder column ``batch_id``."""
    return StructType([*table.fields, StructField(BATCH_ID, LongType(), True)])
