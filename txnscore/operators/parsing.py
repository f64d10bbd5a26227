"""Parsing and validating transaction messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscore.schemas import MESSAGE, TEXT_LIMITS

ISSUE = "issue"
MALFORMED = "malformed_json"
NO_ID = "null_transaction_id"
NO_LABEL = "null_label"


def parse_records(records: DataFrame) -> DataFrame:
    """Every record as typed message columns, broken ones included.

    ``issue`` names the first fault found and is NULL for a sound row; ``raw_value`` keeps the text of
    rows that cannot be stored. A missing label is an issue to be counted, not a reason to reject.
    """
    text = F.col("value").cast("string").alias("text")
    texts = records.select(F.col("timestamp").alias("kafka_timestamp"), "partition", "offset", text)
    # A generator, because Catalyst copies a plain from_json into every filter on its fields.
    message = F.inline(F.array(F.from_json("text", MESSAGE)))
    fields = texts.select("kafka_timestamp", "partition", "offset", "text", message)
    return fields.withColumn(ISSUE, _first_issue()).select(
        *MESSAGE.fieldNames(),
        "kafka_timestamp",
        "partition",
        "offset",
        ISSUE,
        F.when(~is_storable(), F.col("text")).alias("raw_value"),
    )


def _first_issue() -> Column:
    identity = F.col("transaction_id")
    unreadable = F.get_json_object("text", "$").isNull()
    issue = F.when(identity.isNull() & unreadable, MALFORMED).when(identity.isNull(), NO_ID)
    for name, limit in TEXT_LIMITS.items():
        issue = issue.when(F.length(name) > limit, f"long_{name}")
    return issue.when(F.col("is_fraud_ground_truth").isNull(), NO_LABEL)


def is_storable() -> Column:
    """True for rows with an id whose texts fit the stored columns."""
    return F.coalesce(F.col(ISSUE) == NO_LABEL, F.lit(True))


def storable(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_storable()).drop("raw_value", ISSUE)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(~is_storable()).select(
        ISSUE, "partition", "offset", F.col("raw_value").alias("value")
    )


def parse_messages(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records split into storable messages and rejects with a reason."""
    parsed = parse_records(records)
    return storable(parsed), rejected(parsed)


def parsed_messages(records: DataFrame) -> DataFrame:
    """All messages that carry an id, whatever their other faults."""
    return parse_records(records).where(F.col("transaction_id").isNotNull()).drop("raw_value", ISSUE)


def issue_counts(parsed: DataFrame) -> DataFrame:
    """How many rows show each issue."""
    return parsed.where(F.col(ISSUE).isNotNull()).groupBy(ISSUE).agg(F.count("*").alias("n_rows"))
