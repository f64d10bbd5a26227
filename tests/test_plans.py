"""What the plans must and must not contain."""

import pytest

from txnscore.operators import deciding, parsing, rates, reports
from txnscore.plans import fixtures
from txnscore.plans.queries import QUERIES

HEAVY = {"train_eval", "model_metadata", "score_gbt", "feature_importance", "csv_dataset"}
LAZY = sorted(name for name in QUERIES if name not in HEAVY and not name.startswith(("stream_", "insert_")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_everything_with_everything(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_each_record_is_parsed_once(spark, sf_dir):
    text = QUERIES["score_records"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_scoring_is_a_narrow_plan(spark, sf_dir):
    scored = deciding.decide(fixtures.with_logistic_score(parsing.parse_messages(fixtures.records(spark, sf_dir))[0]))
    text = plan(deciding.transaction_records(scored, processing_ms=scored["Amount"]))
    # The only exchanges are those of the test fixture: its spreading and its broadcast of vectors.
    assert text.count("Exchange hashpartitioning") == 0 and text.count("Exchange SinglePartition") == 0


def test_last_rows_are_taken_without_a_global_sort(spark, sf_dir):
    text = plan(QUERIES["recent_transactions"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_rates_read_one_column(spark, sf_dir):
    text = plan(rates.windowed_rate(fixtures.arrivals(spark, sf_dir), "ts", 60, 15))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text and "Expand" not in text


def test_windows_are_summed_from_slides(spark, sf_dir):
    text = plan(rates.windowed_rate(fixtures.arrivals(spark, sf_dir), "ts", 60, 15))
    # Exploding comes above the first final aggregate, so it copies slide totals and not rows.
    explode, scan = text.index("Generate explode"), text.index("FileScan")
    assert "partial_count(1)" in text[explode:scan]


def test_reports_prune_components(spark, sf_dir):
    text = plan(reports.class_profile(fixtures.transactions(spark, sf_dir)))
    assert "embedding" not in text[text.index("ReadSchema") :].split("ReadSchema")[-1]


def test_area_computes_scores_once(spark, sf_dir):
    df = QUERIES["roc_auc"](spark, sf_dir)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    # What is left to do reads the counts per score only.
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and not any("embedding" in line or "event_id" in line for line in scans)
