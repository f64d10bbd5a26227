"""Small hand-made frames."""

import json
from datetime import datetime

from txnscore.schemas import COMPONENTS, KAFKA_RECORD, TRANSACTIONS

NOON = datetime(2024, 1, 1, 12, 0, 0)


def message(number, **changes):
    fields = {
        "transaction_id": f"TXN-{number:08d}",
        "timestamp": 1704110400.0 + number,
        "timestamp_iso": "2024-01-01T12:00:00",
        "Time": float(number),
        "Amount": 10.0,
        **{name: 0.0 for name in COMPONENTS},
        "is_fraud_ground_truth": 0,
        "merchant_id": "MERCHANT-0001",
        "card_last_four": "1234",
        "country": "US",
    }
    fields.update(changes)
    return {name: value for name, value in fields.items() if value is not ...}


def record(number, value, partition=0, offset=None):
    if isinstance(value, dict):
        value = json.dumps(value)
    if isinstance(value, str):
        value = value.encode()
    return (str(number).encode(), value, "raw_transactions", partition, number if offset is None else offset, NOON)


def records(spark, rows):
    return spark.createDataFrame(rows, KAFKA_RECORD)


def stored(spark, rows):
    """Rows (id, amount, partition, offset) in the shape the transaction sink takes."""
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in TRANSACTIONS.fields)
    full = [
        (name, NOON, amount, 0.5, True, 0, "MERCHANT-0001", "1234", "US", 1.0, partition, offset)
        for name, amount, partition, offset in rows
    ]
    return spark.createDataFrame(full, schema + ", partition int, offset bigint")
