"""Validation of records."""

import json

from frames import message, record, records
from txnscore.operators.parsing import issue_counts, parse_messages, parse_records, parsed_messages
from txnscore.operators.producing import to_keyed_records
from txnscore.schemas import MESSAGE


def test_message_has_37_fields():
    assert len(MESSAGE) == 37


def issues(spark, *values):
    df = parse_records(records(spark, [record(i, value) for i, value in enumerate(values)]))
    return [row["issue"] for row in df.orderBy("offset").collect()]


def test_issue_of_each_fault(spark):
    assert issues(
        spark,
        message(1),
        "not json",
        message(2, transaction_id=...),
        message(3, transaction_id=None),
        message(4, country="USA"),
        message(5, card_last_four="12345"),
        message(6, merchant_id="M" * 21),
        message(7, transaction_id="T" * 21),
        message(8, is_fraud_ground_truth=None),
        None,
        "",
        "{}",
    ) == [
        None,
        "malformed_json",
        "null_transaction_id",
        "null_transaction_id",
        "long_country",
        "long_card_last_four",
        "long_merchant_id",
        "long_transaction_id",
        "null_label",
        "malformed_json",
        "malformed_json",
        "null_transaction_id",
    ]


def test_wrong_type_becomes_null_and_the_row_stays(spark):
    valid, rejects = parse_messages(records(spark, [record(1, message(1, Amount="x"))]))
    row = valid.first()
    assert row["Amount"] is None and row["transaction_id"] == "TXN-00000001" and row["country"] == "US"
    assert rejects.count() == 0


def test_unlabelled_rows_are_stored_and_counted(spark):
    rows = records(spark, [record(1, message(1, is_fraud_ground_truth=None)), record(2, message(2))])
    valid, rejects = parse_messages(rows)
    assert valid.count() == 2 and rejects.count() == 0
    assert [tuple(row) for row in issue_counts(parse_records(rows)).collect()] == [("null_label", 1)]


def test_rejects_keep_their_text_and_place(spark):
    _, rejects = parse_messages(records(spark, [record(1, message(1)), record(2, "not json", partition=2, offset=77)]))
    assert [tuple(row) for row in rejects.collect()] == [("malformed_json", 2, 77, "not json")]


def test_parsed_row_shape(spark):
    parsed = parsed_messages(records(spark, [record(1, message(1, country="USA"))]))
    assert parsed.columns == [*MESSAGE.fieldNames(), "kafka_timestamp", "partition", "offset"]
    assert parsed.count() == 1


def test_unknown_fields_are_ignored(spark):
    assert issues(spark, message(1, extra={"a": [1, 2]})) == [None]


def test_json_round_trip(spark):
    sent = message(7, V1=-1.25e-17, V2=0.1, Amount=123456789.01, merchant_id='quote " and ümlaut')
    valid, _ = parse_messages(records(spark, [record(7, sent)]))
    keyed = to_keyed_records(valid, "offset").first()
    assert bytes(keyed["key"]) == b"7"
    assert json.loads(bytes(keyed["value"])) == sent
