"""Outcome counts, reports and the area under the ROC curve."""

import random

import pytest

from txnscore.operators.evaluation import classification_report, confusion, evaluate, roc_auc


def frame(spark, rows):
    return spark.createDataFrame(rows, "fraud_probability double, is_fraud_ground_truth int, is_fraud_predicted boolean")


def scored(spark, pairs):
    return frame(spark, [(score, label, bool(score is not None and score >= 0.5)) for score, label in pairs])


def brute_auc(pairs):
    positives = [s for s, y in pairs if y == 1]
    negatives = [s for s, y in pairs if y == 0]
    won = sum((p > n) + (p == n) / 2 for p in positives for n in negatives)
    return won / (len(positives) * len(negatives))


@pytest.mark.parametrize("distinct", [1, 2, 5, 1000])
@pytest.mark.parametrize("partitions", ["1", "3", "64"])
def test_auc_equals_all_pairs(spark, distinct, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rng = random.Random(distinct)
    pairs = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.2)) for _ in range(600)]
    pairs += [(0.5, 0), (0.5, 1)]
    try:
        assert roc_auc(scored(spark, pairs)).first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("seed", [1, 2, 7, 1000])
def test_auc_of_piled_up_scores(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.random() ** 6, int(rng.random() < 0.3)) for _ in range(500)] + [(0.0, 0), (0.0, 1), (1.0, 1)]
    area = roc_auc(scored(spark, pairs)).first()[0]
    assert area == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_with_a_third_of_rows_at_one_score(spark):
    rng = random.Random(3)
    pairs = [(0.001, int(i % 50 == 0)) for i in range(300)] + [(rng.random() ** 8, i % 2) for i in range(600)]
    assert roc_auc(scored(spark, pairs)).first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)


@pytest.mark.parametrize("pairs", [[], [(0.3, 1)], [(0.3, 0), (0.4, 0)], [(None, 1), (0.2, 0)]])
def test_auc_needs_both_classes(spark, pairs):
    assert roc_auc(scored(spark, pairs)).collect()[0][0] is None


def test_auc_leaves_out_unlabelled_and_unscored_rows(spark):
    pairs = [(0.9, 1), (0.1, 0), (0.95, None), (None, 1), (float("nan"), 0)]
    assert roc_auc(scored(spark, pairs)).first()[0] == 1.0


def test_confusion(spark):
    rows = [(0.1, 0, False)] * 5 + [(0.9, 0, True)] * 2 + [(0.2, 1, False)] + [(0.8, 1, True)] * 3 + [(0.8, None, True)]
    row = confusion(frame(spark, rows)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (5, 2, 1, 3)
    assert row["fpr_pct"] == pytest.approx(200 / 7) and row["fnr_pct"] == 25.0


def test_report(spark):
    rows = [(0.1, 0, False)] * 5 + [(0.9, 0, True)] * 2 + [(0.2, 1, False)] + [(0.8, 1, True)] * 3
    report = {row["class_name"]: row for row in classification_report(frame(spark, rows)).collect()}
    assert list(report) == ["Legitimate", "Fraud", "accuracy", "macro avg", "weighted avg"]
    fraud, legitimate = report["Fraud"], report["Legitimate"]
    assert (fraud["precision"], fraud["recall"], fraud["support"]) == (0.6, 0.75, 4)
    assert fraud["f1_score"] == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert (legitimate["precision"], legitimate["support"]) == (pytest.approx(5 / 6), 7)
    assert report["accuracy"]["f1_score"] == pytest.approx(8 / 11) and report["accuracy"]["precision"] is None
    assert report["macro avg"]["recall"] == pytest.approx((5 / 7 + 0.75) / 2)
    assert report["weighted avg"]["recall"] == pytest.approx(8 / 11)
    assert report["weighted avg"]["support"] == 11


def test_report_without_any_fraud(spark):
    report = {row["class_name"]: row for row in classification_report(scored(spark, [(0.1, 0), (0.2, 0)])).collect()}
    assert (report["Fraud"]["precision"], report["Fraud"]["recall"], report["Fraud"]["f1_score"]) == (0.0, 0.0, 0.0)
    assert report["Legitimate"]["f1_score"] == 1.0


def test_report_of_nothing(spark):
    assert classification_report(scored(spark, [])).count() == 5


def test_evaluate(spark):
    row = evaluate(scored(spark, [(0.9, 1), (0.6, 0), (0.4, 1), (0.1, 0)])).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["auc_roc"]) == (0.5, 0.5, 0.5, 0.75)
