"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.config import ScoringConfig, SinkPaths
from txnscore.functions import buckets
from txnscore.functions.decisions import severity
from txnscore.functions.messages import transaction_id
from txnscore.operators import (
    deciding,
    evaluation,
    histograms,
    metrics,
    parsing,
    preparation,
    producing,
    rates,
    reports,
    training,
)
from txnscore.operators.deciding import ACTUAL, FLAG, SCORE
from txnscore.plans import fixtures
from txnscore.schemas import ALERTS, BATCH_METRICS, BATCH_SERIES, COMPONENTS, MESSAGE, REJECTS, TRANSACTIONS
from txnscore.sinks.tables import insert_if_absent, read_table
from txnscore.sources.dataset import read_dataset
from txnscore.sources.log import EARLIEST, LATEST, append_to_log, log_stream, retire
from txnscore.sources.models import load_model, save_model
from txnscore.sources.records import record_stream
from txnscore.streaming.rates import start_bucket_totals, start_pane_totals, streamed_quantiles, streamed_rate
from txnscore.streaming.scoring import start_scoring, work_off
from txnscore.workspace import new_folder, written

AMOUNT_BOUNDS = [1.0, 5.0, 10.0, 50.0, 100.0, 500.0]

#: What a model that has learned the planted signal reaches on rows it has not seen; one that has not stays far below.
AUC_FLOOR, RECALL_FLOOR, PRECISION_FLOOR, RIGHT_FLOOR = 0.75, 0.5, 0.5, 0.8
#: What the features behind the planted signal are worth at least, each and together; evenly spread, each has a thirtieth.
EACH_FLOOR, SIGNAL_FLOOR = 0.04, 0.7

Query = Callable[[SparkSession, str], DataFrame]


def _shown(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns, the score as decimal so that the last bits of a double do not matter."""
    return df.select(
        *[F.col(name).cast("decimal(18,6)").alias(name) if name == SCORE else F.col(name) for name in cols]
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records parsed, scored, decided and summed up."""
    messages, _ = parsing.parse_messages(fixtures.records(spark, sf_dir, defects=True))
    decided = deciding.decide(fixtures.with_logistic_score(messages))
    stored = deciding.transaction_records(decided, processing_ms=F.lit(20.0) + F.col("partition"))
    return reports.fraud_summary(stored)


# Records and messages


def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsing.parsed_messages(fixtures.records(spark, sf_dir, defects=True))
    return parsed.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = parsing.parse_messages(fixtures.records(spark, sf_dir, defects=True))
    return rejects.select("issue", "partition", "offset", (F.col("value") == "not json").alias("not_json"))


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.issue_counts(parsing.parse_records(fixtures.records(spark, sf_dir, defects=True)))


def build_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return producing.build_messages(fixtures.transactions(spark, sf_dir, costly=True), "event_id", "ts")


def keyed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir, costly=True)
    messages = producing.build_messages(rows, "event_id", "ts", keep=("event_id",))
    keyed = producing.to_keyed_records(messages, "event_id")
    message = F.from_json(F.col("value").cast("string"), MESSAGE)
    return keyed.select(F.col("key").cast("string").alias("key"), message.alias("message")).select(
        "key", "message.*"
    )


def csv_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "dataset")
    columns = ["Time", *COMPONENTS, "Amount", "Class"]
    fixtures.transactions(spark, sf_dir, costly=True).select(*columns).write.csv(path, header=True)
    return read_dataset(spark, path)


# Decisions


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.decided(spark, sf_dir).withColumn("severity", severity(F.col(SCORE)))
    return _shown(rows, "transaction_id", SCORE, FLAG, "severity")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = deciding.alerts(fixtures.decided(spark, sf_dir), raised_at=F.col("ts"))
    return _shown(raised, *raised.columns)


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = deciding.alerts(fixtures.decided(spark, sf_dir), raised_at=F.col("ts"))
    fields = ["alert_id", "transaction_id", "merchant_id", "country", "card_last_four", "severity"]
    return deciding.alert_values(raised).select(F.json_tuple("value", *fields).alias(*fields))


def transaction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = deciding.transaction_records(fixtures.decided(spark, sf_dir), processed_at=F.col("ts"))
    return _shown(stored, *stored.columns)


def high_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deciding.high_confidence(fixtures.decided(spark, sf_dir))


# Dataset, split and preparation


def class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.class_profile(fixtures.transactions(spark, sf_dir))


def split_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = preparation.hash_split(fixtures.transactions(spark, sf_dir), "transaction_id")
    return reports.split_profile(split)


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = preparation.stratified_split(fixtures.transactions(spark, sf_dir))
    return split.select("transaction_id", "Class", "split")


def class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = preparation.stratified_split(fixtures.transactions(spark, sf_dir))
    return preparation.class_weight(split.where(F.col("split") == preparation.TRAIN))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.arrivals(spark, sf_dir).withColumn("transaction_id", transaction_id(F.col("event_id")))
    scaled = preparation.scale_columns(rows, preparation.fit_scale(rows))
    return scaled.select(
        "transaction_id", *[F.col(name).cast("decimal(18,6)").alias(f"scaled_{name}") for name in ("Time", "Amount")]
    )


# Micro-batches


def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.batch_stats(fixtures.decided(spark, sf_dir), "batch_id")


def running_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.running_counters(fixtures.batch_metrics(spark, sf_dir))


def sent_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.running_counters(fixtures.batch_metrics(spark, sf_dir), metrics.SENT)


def batch_count_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.batch_count_series(fixtures.batch_metrics(spark, sf_dir))


def latest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest_rate(fixtures.batch_metrics(spark, sf_dir))


def recent_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fixtures.batch_metrics(spark, sf_dir).withColumn("processed_at", F.col("last_ts"))
    return reports.recent_batches(stored)


# Reports


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deciding.transaction_records(fixtures.decided(spark, sf_dir), processed_at=F.col("ts"))


def fraud_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fraud_summary(_stored(spark, sf_dir))


def health_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.health_count(_stored(spark, sf_dir))


def recent_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_transactions(_stored(spark, sf_dir))


# Evaluation


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion(fixtures.decided(spark, sf_dir))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluation.classification_report(fixtures.decided(spark, sf_dir))
    return report.select(
        "class_name",
        *[F.col(name).cast("decimal(18,6)").alias(name) for name in ("precision", "recall", "f1_score")],
        "support",
    )


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = evaluation.roc_auc(fixtures.decided(spark, sf_dir))
    return area.select(F.col("auc_roc").cast("decimal(18,10)").alias("auc_roc"))


def score_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts stored beside a model, here for the fixed score."""
    split = preparation.stratified_split(fixtures.with_logistic_score(fixtures.transactions(spark, sf_dir)))
    area = evaluation.roc_auc(split.where(F.col("split") == preparation.TEST))
    facts = training.model_metadata(split, area)
    return facts.withColumn("features", F.array_join("features", " "))


# Histograms and series


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histograms.bucket_histogram(fixtures.decided(spark, sf_dir), SCORE, buckets.SCORE)


def score_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = histograms.histogram_arrays(fixtures.decided(spark, sf_dir), SCORE, buckets.SCORE)
    return histograms.bucket_differences(arrays, buckets.SCORE)


def size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histograms.bucket_histogram(fixtures.batch_metrics(spark, sf_dir), "batch_size", buckets.BATCH_SIZE)


def batch_seconds_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = fixtures.batch_metrics(spark, sf_dir).withColumn("seconds", F.col("processing_ms") / 1000)
    return histograms.bucket_histogram(timed, "seconds", buckets.BATCH_SECONDS)


def inference_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = fixtures.arrivals(spark, sf_dir).withColumn("seconds", F.col("processing_time_ms") / 1000)
    return histograms.bucket_histogram(timed, "seconds", buckets.INFERENCE_SECONDS, "country")


def send_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = fixtures.arrivals(spark, sf_dir).withColumn("seconds", F.col("Amount") / 1000)
    return histograms.bucket_histogram(timed, "seconds", buckets.SEND_SECONDS)


def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fixtures.arrivals(spark, sf_dir).withColumn("day", F.to_date("ts"))
    quantiles = histograms.histogram_quantile(daily, "Amount", AMOUNT_BOUNDS, [0.5, 0.95], "day")
    return quantiles.select("day", *[F.col(n).cast("decimal(18,6)").alias(n) for n in ("p50", "p95")])


def inference_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = fixtures.arrivals(spark, sf_dir).select(
        F.window("ts", "5 minutes")["start"].alias("window_start"),
        (F.col("processing_time_ms") / 1000).alias("seconds"),
    )
    bounds = buckets.INFERENCE_SECONDS
    quantiles = histograms.histogram_quantile(timed, "seconds", bounds, [0.5, 0.95], "window_start")
    return quantiles.select("window_start", *[F.col(n).cast("decimal(18,6)").alias(n) for n in ("p50", "p95")])


def windowed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.windowed_rate(fixtures.arrivals(spark, sf_dir), "ts", 60, 15)


def detected_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = {"detected_rate": F.col(FLAG), "actual_rate": F.col(ACTUAL) == 1}
    return rates.windowed_rate(fixtures.decided(spark, sf_dir), "ts", 3600, 900, series)


def achieved_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.achieved_rate(fixtures.arrivals(spark, sf_dir), "ts")


# Sinks and streams


def insert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second repeating a tenth of the ids, both stored and the second replayed."""
    path = SinkPaths.under(new_folder(spark, "insert")).transactions
    first = fixtures.decided(spark, sf_dir, costly=True)
    again = first.where(F.col("event_id") % fixtures.RESENT_EVERY == 0).withColumns(
        {"Amount": F.col("Amount") + 1, "offset": F.col("offset") + fixtures.RESENT_OFFSET}
    )
    both = {0: first, 1: first.unionByName(again)}
    for batch_id in (0, 1, 1):
        rows = both[batch_id]
        records = deciding.transaction_records(rows, processed_at=F.col("ts"), keep=("partition", "offset"))
        insert_if_absent(records, path, batch_id)
    stored = read_table(spark, path, TRANSACTIONS)
    return _shown(stored, "transaction_id", "amount", SCORE, FLAG, ACTUAL, "merchant_id", "country")


def _run_stream(spark: SparkSession, sf_dir: str) -> SinkPaths:
    """Records, broken ones among them, through the scoring job; then a restart with the resent ones."""
    folder = new_folder(spark, "stream")
    paths = SinkPaths.under(f"{folder}/tables")
    for resent in (False, True):
        fixtures.records(spark, sf_dir, defects=True, resent=resent).write.mode("append").parquet(f"{folder}/inbox")
        records = record_stream(spark, f"{folder}/inbox")
        query = start_scoring(
            records, fixtures.with_logistic_score, paths, f"{folder}/checkpoint", available_now=True
        )
        query.awaitTermination()
    return paths


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, _run_stream(spark, sf_dir).transactions, TRANSACTIONS)
    columns = ["transaction_id", "amount", SCORE, FLAG, ACTUAL, "merchant_id", "card_last_four", "country"]
    return _shown(stored, *columns)


def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checkpoints on the same tables; the second reads all records again and the resent ones."""
    folder = new_folder(spark, "stream")
    paths = SinkPaths.under(f"{folder}/tables")
    for resent in (False, True):
        fixtures.records(spark, sf_dir, defects=True, resent=resent).write.mode("append").parquet(f"{folder}/inbox")
        records = record_stream(spark, f"{folder}/inbox")
        query = start_scoring(
            records, fixtures.with_logistic_score, paths, f"{folder}/checkpoint-{resent}", available_now=True
        )
        query.awaitTermination()
    stored = read_table(spark, paths.transactions, TRANSACTIONS)
    columns = ["transaction_id", "amount", SCORE, FLAG, ACTUAL, "merchant_id", "card_last_four", "country"]
    return _shown(stored, *columns)


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, _run_stream(spark, sf_dir).alerts, ALERTS)
    return _shown(stored, "alert_id", "transaction_id", SCORE, "amount", "merchant_id", "country", "severity")


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, _run_stream(spark, sf_dir).batch_metrics, BATCH_METRICS)
    return stored.agg(F.sum("batch_size").alias("processed"), F.sum("fraud_count").alias("detected"))


def stream_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = read_table(spark, _run_stream(spark, sf_dir).batch_series, BATCH_SERIES)
    arrays = histograms.merge_histogram_arrays(series, "score_buckets", len(buckets.SCORE))
    return histograms.histogram_rows(arrays, buckets.SCORE)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, _run_stream(spark, sf_dir).rejects, REJECTS)
    return stored.groupBy("issue").agg(F.count("*").alias("n_rows"))


def _score_log(spark: SparkSession, folder: str, **options) -> SinkPaths:
    """The scoring job over the record log of a folder, on its one checkpoint, until nothing is left to read."""
    paths = SinkPaths.under(f"{folder}/tables")
    records = log_stream(spark, f"{folder}/log", **options)
    job = start_scoring(
        records, fixtures.with_logistic_score, paths, f"{folder}/checkpoint", ScoringConfig(batch_interval_seconds=0)
    )
    work_off(job)
    return paths


def stream_intake_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each batch where three tenths of all records are the most that one may take."""
    folder = new_folder(spark, "log")
    append_to_log(fixtures.records(spark, sf_dir), f"{folder}/log")
    limit = max(1, 3 * fixtures.read(spark, sf_dir, "events").count() // 10)
    paths = _score_log(spark, folder, starting_offsets=EARLIEST, max_offsets_per_trigger=limit)
    return read_table(spark, paths.batch_metrics, BATCH_METRICS).select("batch_id", "batch_size")


def stream_latest_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that starts behind all records: an empty batch, an orderly stop, then only what was sent after its start."""
    folder = new_folder(spark, "log")
    for resent in (False, True):
        append_to_log(fixtures.records(spark, sf_dir, defects=True, resent=resent), f"{folder}/log")
        paths = _score_log(spark, folder, starting_offsets=LATEST, max_offsets_per_trigger=1_000_000)
    stored = read_table(spark, paths.transactions, TRANSACTIONS)
    return _shown(stored, "transaction_id", "amount", SCORE, FLAG, ACTUAL, "country")


def stream_lost_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle third of each partition is removed unread: the job fails, and told to bear losses goes on behind it."""
    folder, records = new_folder(spark, "log"), fixtures.records(spark, sf_dir)
    events = fixtures.arrivals(spark, sf_dir)
    third = events.agg((F.max("offset") / 3).cast("long")).first()[0]
    tolerant, strict = {"max_offsets_per_trigger": 1_000_000_000, "starting_offsets": EARLIEST}, []
    append_to_log(records.where(F.col("offset") < third), f"{folder}/log")
    paths = _score_log(spark, folder, **tolerant)
    append_to_log(records.where(F.col("offset").between(third, 2 * third - 1)), f"{folder}/log")
    append_to_log(records.where(F.col("offset") >= 2 * third), f"{folder}/log")
    retire(f"{folder}/log", dict.fromkeys(range(fixtures.PARTITIONS), 2 * third))
    try:
        _score_log(spark, folder, **tolerant)
    except StreamingQueryException as error:
        strict.append("LostRecordsError" in str(error))
    paths = _score_log(spark, folder, **tolerant, fail_on_data_loss=False)
    stored = read_table(spark, paths.transactions, TRANSACTIONS)
    return _shown(stored, "transaction_id", "amount", SCORE).withColumn("failed_first", F.lit(strict == [True]))


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream. A pattern, since a stream takes the name of a folder only; it stands for one file, too."""
    return spark.readStream.schema(fixtures.read(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")


def stream_windowed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All one-hour windows, open ones too, from totals that a stream keeps."""
    folder = new_folder(spark, "rates")
    events = _arriving(spark, sf_dir)
    start_pane_totals(
        events, "ts", f"{folder}/totals", f"{folder}/checkpoint", 3600, 900, available_now=True
    ).awaitTermination()
    windows = streamed_rate(spark, f"{folder}/totals", 3600, 900)
    return windows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_rate_over_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checkpoints on one table of totals, each with its own half of the events; the rates are those of all."""
    folder = new_folder(spark, "rates")
    for half in (0, 1):
        events = _arriving(spark, sf_dir).where(F.col("event_id") % 2 == half)
        start_pane_totals(
            events, "ts", f"{folder}/totals", f"{folder}/checkpoint-{half}", 3600, 900, available_now=True
        ).awaitTermination()
    windows = streamed_rate(spark, f"{folder}/totals", 3600, 900)
    return windows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_inference_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency quantiles of five-minute windows from bucket counts that a stream keeps, over a new checkpoint."""
    folder, bounds = new_folder(spark, "latency"), buckets.INFERENCE_SECONDS
    for half in (0, 1):
        timed = fixtures.as_arrivals(_arriving(spark, sf_dir)).where(F.col("event_id") % 2 == half)
        start_bucket_totals(
            timed, "ts", F.col("processing_time_ms") / 1000, bounds, f"{folder}/totals", f"{folder}/checkpoint-{half}", 300,
            available_now=True,
        ).awaitTermination()
    quantiles = streamed_quantiles(spark, f"{folder}/totals", bounds, [0.5, 0.95])
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return quantiles.select(start, *[F.col(n).cast("decimal(18,6)").alias(n) for n in ("p50", "p95")])


# Models


_FITTED: dict[tuple[str, str], PipelineModel] = {}


def _trained(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    """A model of the published size over planted labels, and the split; trained once per application and table.

    A transaction is labelled 1 where the fixed score flags it, so there is something to learn. Events share vectors,
    so whole vectors go to either part; otherwise the test part would be known. The model is the fitted one, never saved,
    so that what a saved one loses can be seen beside it.
    """
    planted = fixtures.decided(spark, sf_dir, costly=True).withColumn("Class", F.col(FLAG).cast("int"))
    split = preparation.hash_split(planted.drop(SCORE, FLAG), "vec_id")
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _FITTED:
        _FITTED[key] = training.train(split.where(F.col("split") == preparation.TRAIN))
    return _FITTED[key], split


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split = _trained(spark, sf_dir)
    return training.score(split.where(F.col("split") == preparation.TEST), model)


def train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the hold-out per class, and whether the model tells them apart."""
    result = evaluation.evaluate(_held_out(spark, sf_dir), "Class")
    return result.select(
        (F.col("tn") + F.col("fp")).alias("n_legitimate"),
        (F.col("fn") + F.col("tp")).alias("n_fraud"),
        (F.col("auc_roc") >= AUC_FLOOR).alias("auc_reached"),
        (F.col("recall") >= RECALL_FLOOR).alias("recall_reached"),
        (F.col("precision") >= PRECISION_FLOOR).alias("precision_reached"),
    )


def model_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, split = _trained(spark, sf_dir)
    facts = training.model_metadata(split, evaluation.roc_auc(_held_out(spark, sf_dir), label="Class"))
    return facts.withColumns(
        {"features": F.array_join("features", " "), "auc_roc": F.col("auc_roc") >= AUC_FLOOR}
    ).withColumnRenamed("auc_roc", "auc_reached")


def score_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction scored by a model that was saved and loaded again: whether its score and flag are sound, beside the
    rows of its class, the largest difference of scores before and after saving, and whether most are decided right."""
    model, split = _trained(spark, sf_dir)
    folder = new_folder(spark, "model")
    save_model(model, folder)
    both = training.score(split, model).withColumnRenamed(SCORE, "before")
    decided = deciding.decide(training.score(both, load_model(folder)))
    # Written down, so that the models run once per row for the rows and for their classes.
    scored = written(
        decided.select(
            "transaction_id",
            "Class",
            F.col(SCORE).between(0.0, 1.0).alias("score_sound"),
            (F.col(FLAG) == (F.col(SCORE) >= 0.5)).alias("flag_sound"),
            F.abs(F.col(SCORE) - F.col("before")).alias("difference"),
            (F.col(FLAG) == (F.col("Class") == 1)).cast("int").alias("right"),
        ),
        "scored",
    )
    classes = scored.groupBy(F.col("Class").alias("of_class")).agg(
        F.count("*").alias("n_rows"),
        F.max("difference").alias("largest_difference"),
        (F.avg("right") >= RIGHT_FLOOR).alias("mostly_right"),
    )
    rows = scored.join(F.broadcast(classes), F.col("Class").eqNullSafe(F.col("of_class")))  # one row per class
    return rows.select(
        "transaction_id", "Class", "score_sound", "flag_sound", "n_rows", "largest_difference", "mostly_right"
    )


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of the planted signal, which must matter more than others, beside sums over all."""
    model, _ = _trained(spark, sf_dir)
    every = training.feature_importance(spark, model)
    planted = F.col("feature").isin(list(fixtures.WEIGHTS))
    sums = every.agg(
        F.count("*").alias("n_features"),
        F.sum("importance").cast("decimal(18,6)").alias("total"),
        (F.sum(F.when(planted, F.col("importance"))) >= SIGNAL_FLOOR).alias("signal_found"),
    )
    found = every.where(planted).select("feature", (F.col("importance") >= EACH_FLOOR).alias("matters"))
    return found.crossJoin(F.broadcast(sums))  # four rows by one


def pandas_udf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir, costly=True)
    scored = training.score_udf(rows, fixtures.logistic_factory(), features=list(fixtures.WEIGHTS))
    return _shown(scored, "transaction_id", SCORE)


QUERIES: dict[str, Query] = {
    "score_records": flagship,
    "parse_messages": parse_messages,
    "rejected_records": rejected_records,
    "reject_counts": reject_counts,
    "build_messages": build_messages,
    "keyed_records": keyed_records,
    "csv_dataset": csv_dataset,
    "decisions": decisions,
    "alerts": alerts,
    "alert_messages": alert_messages,
    "transaction_records": transaction_records,
    "high_confidence": high_confidence,
    "class_profile": class_profile,
    "split_profile": split_profile,
    "stratified_split": stratified_split,
    "class_weight": class_weight,
    "scaled_features": scaled_features,
    "batch_stats": batch_stats,
    "running_counters": running_counters,
    "sent_counters": sent_counters,
    "batch_count_series": batch_count_series,
    "latest_rate": latest_rate,
    "recent_batches": recent_batches,
    "fraud_summary": fraud_summary,
    "health_count": health_count,
    "recent_transactions": recent_transactions,
    "confusion": confusion,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
    "score_metadata": score_metadata,
    "score_histogram": score_histogram,
    "score_buckets": score_buckets,
    "size_histogram": size_histogram,
    "batch_seconds_histogram": batch_seconds_histogram,
    "inference_histogram": inference_histogram,
    "send_histogram": send_histogram,
    "histogram_quantile": histogram_quantile,
    "inference_latency": inference_latency,
    "windowed_rate": windowed_rate,
    "detected_vs_actual": detected_vs_actual,
    "achieved_rate": achieved_rate,
    "insert_if_absent": insert_twice,
    "stream_score": stream_score,
    "stream_new_checkpoint": stream_new_checkpoint,
    "stream_alerts": stream_alerts,
    "stream_totals": stream_totals,
    "stream_score_histogram": stream_score_histogram,
    "stream_rejects": stream_rejects,
    "stream_intake_limit": stream_intake_limit,
    "stream_latest_start": stream_latest_start,
    "stream_lost_range": stream_lost_range,
    "stream_windowed_rate": stream_windowed_rate,
    "stream_rate_over_checkpoints": stream_rate_over_checkpoints,
    "stream_inference_latency": stream_inference_latency,
    "train_eval": train_eval,
    "model_metadata": model_metadata,
    "score_gbt": score_gbt,
    "feature_importance": feature_importance,
    "pandas_udf_score": pandas_udf_score,
}
