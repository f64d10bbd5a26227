"""Measuring decisions and scores against known labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscore.config import FRAUD_THRESHOLD
from txnscore.functions.decisions import guarded_ratio, number_or_null
from txnscore.operators.deciding import ACTUAL, FLAG, SCORE, decide
from txnscore.operators.running import running_sums
from txnscore.workspace import written


def confusion(decided: DataFrame, label: str = ACTUAL, flag: str = FLAG) -> DataFrame:
    """Counts of the four outcomes and both error rates in percent; unlabelled rows are left out."""
    actual, flagged = F.col(label) == 1, F.col(flag)
    cells = decided.where(F.col(label).isNotNull()).agg(
        F.count_if(~actual & ~flagged).alias("tn"),
        F.count_if(~actual & flagged).alias("fp"),
        F.count_if(actual & ~flagged).alias("fn"),
        F.count_if(actual & flagged).alias("tp"),
    )
    return cells.withColumns(
        {
            "fpr_pct": guarded_ratio(F.col("fp"), F.col("tn") + F.col("fp")) * 100,
            "fnr_pct": guarded_ratio(F.col("fn"), F.col("fn") + F.col("tp")) * 100,
        }
    )


def classification_report(decided: DataFrame, label: str = ACTUAL, flag: str = FLAG) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and both averages."""
    cells = confusion(decided, label, flag)
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    scores = cells.select(
        *_class_scores("legitimate", hits=tn, false_alarms=fn, misses=fp),
        *_class_scores("fraud", hits=tp, false_alarms=fp, misses=fn),
        guarded_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        (tp + tn + fp + fn).alias("total"),
    ).withColumns({f"{name}_f1": _f1(name) for name in ("legitimate", "fraud")})
    nothing = F.lit(None).cast("double")
    rows = [
        _report_row("Legitimate", *[F.col(f"legitimate_{m}") for m in ("precision", "recall", "f1", "support")]),
        _report_row("Fraud", *[F.col(f"fraud_{m}") for m in ("precision", "recall", "f1", "support")]),
        _report_row("accuracy", nothing, nothing, F.col("accuracy"), F.col("total")),
        _report_row("macro avg", *[_macro(m) for m in ("precision", "recall", "f1")], F.col("total")),
        _report_row("weighted avg", *[_weighted(m) for m in ("precision", "recall", "f1")], F.col("total")),
    ]
    return scores.select(F.inline(F.array(*rows)))


def _class_scores(name: str, hits: Column, false_alarms: Column, misses: Column) -> list[Column]:
    return [
        guarded_ratio(hits, hits + false_alarms).alias(f"{name}_precision"),
        guarded_ratio(hits, hits + misses).alias(f"{name}_recall"),
        (hits + misses).alias(f"{name}_support"),
    ]


def _f1(name: str) -> Column:
    precision, recall = F.col(f"{name}_precision"), F.col(f"{name}_recall")
    return guarded_ratio(2 * precision * recall, precision + recall)


def _macro(measure: str) -> Column:
    return (F.col(f"legitimate_{measure}") + F.col(f"fraud_{measure}")) / 2


def _weighted(measure: str) -> Column:
    parts = [F.col(f"{name}_{measure}") * F.col(f"{name}_support") for name in ("legitimate", "fraud")]
    return guarded_ratio(parts[0] + parts[1], F.col("total"))


def _report_row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
    return F.struct(
        F.lit(name).alias("class_name"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        support.alias("support"),
    )


def roc_auc(df: DataFrame, score: str = SCORE, label: str = ACTUAL) -> DataFrame:
    """Exact area under the ROC curve, ties counting half; NULL unless both classes occur.

    Rows collapse to one per score before anything is ordered. The scores are then dealt out by range, so that
    each task holds about as many, wherever they pile up; the ranges are written down as blocks, whose totals carry
    the running sums across them. The scores are computed once.
    """
    known = df.where(F.col(label).isNotNull()).select(
        number_or_null(F.col(score)).alias("score"), (F.col(label) == 1).alias("positive")
    )
    per_score = (
        known.where(F.col("score").isNotNull())
        .groupBy("score")
        .agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    )
    blocks = written(per_score.repartitionByRange("score").withColumn("block", F.spark_partition_id()), "scores")
    ranked = running_sums(
        blocks,
        F.col("block"),
        "score",
        {"neg_below": "neg"},
        inclusive=False,
        overall={"all_pos": "pos", "all_neg": "neg"},
    )
    pairs = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    possible = F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
    return ranked.agg((F.sum(pairs) / F.nullif(possible, F.lit(0.0))).alias("auc_roc"))


def evaluate(scored: DataFrame, label: str = ACTUAL, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """One row for a scored hold-out part: area, outcome counts, and precision, recall and F1 of fraud.

    Labels and scores are written down first, so that the model runs once per row.
    """
    scored = written(scored.select(label, SCORE), "holdout")
    cells = confusion(decide(scored, threshold), label)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    measures = cells.withColumns(
        {"precision": guarded_ratio(tp, tp + fp), "recall": guarded_ratio(tp, tp + fn)}
    ).withColumn(
        "f1_score",
        guarded_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    return measures.withColumn("auc_roc", roc_auc(scored, label=label).scalar())
