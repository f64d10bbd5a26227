"""Building transaction messages and keyed records from dataset rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.functions.messages import epoch_seconds, iso_text, transaction_id
from txnscore.schemas import COMPONENTS, LABEL, MESSAGE


def build_messages(
    df: DataFrame, id_col: str, ts_col: str, label_col: str = LABEL, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Dataset rows with an id and an event time as the 37 message fields, in schema order.

    ``merchant_id``, ``card_last_four`` and ``country`` are taken from the rows; ``keep`` names columns to
    carry along behind the message fields.
    """
    features = [F.col(name).cast("double").alias(name) for name in ["Time", "Amount", *COMPONENTS]]
    return df.select(
        transaction_id(F.col(id_col)).alias("transaction_id"),
        epoch_seconds(F.col(ts_col)).alias("timestamp"),
        iso_text(F.col(ts_col)).alias("timestamp_iso"),
        *features,
        F.col(label_col).cast("int").alias("is_fraud_ground_truth"),
        *[F.col(name).cast("string").alias(name) for name in ["merchant_id", "card_last_four", "country"]],
        *keep,
    )


def to_keyed_records(messages: DataFrame, key_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Binary ``key`` and JSON ``value``: equal keys reach the same topic partition."""
    return messages.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*MESSAGE.fieldNames())).cast("binary").alias("value"),
        *keep,
    )
