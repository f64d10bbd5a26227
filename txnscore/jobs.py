"""The four programs: train, produce, score and report."""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnscore.config import BATCH_INTERVAL_SECONDS, FRAUD_THRESHOLD, KafkaSettings, ScoringConfig, SinkPaths
from txnscore.operators import deciding, evaluation, preparation, producing, reports, training
from txnscore.operators.numbering import with_row_numbers
from txnscore.plans.dashboard import REPORTS
from txnscore.schemas import COUNTRIES, LABEL, SENT
from txnscore.session import build_session
from txnscore.sinks.tables import batch_row, write_batch
from txnscore.sinks.topics import alert_sender, send_records
from txnscore.sources.dataset import read_dataset
from txnscore.sources.log import append_to_log, bounds, log_stream
from txnscore.sources.models import load_model, save_metadata, save_model
from txnscore.sources.records import FILES_PER_TRIGGER, kafka_stream, record_stream
from txnscore.streaming.scoring import model_scorer, run_until_stopped, start_scoring, work_off
from txnscore.workspace import written

log = logging.getLogger(__name__)

# Partitions of a record log that the producer writes.
LOG_PARTITIONS = 3

# How many merchants and card numbers dataset rows are given.
MERCHANTS = 1000
CARDS_FROM, CARDS = 1000, 9000


def with_parties(rows: DataFrame, id_col: str) -> DataFrame:
    """Merchant, card and country for rows that have none, drawn from a hash of the row's number."""

    def draw(salt: str, n: int):
        return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.lit(n)).cast("int")

    return rows.withColumns(
        {
            "merchant_id": F.format_string("MERCHANT-%04d", draw("merchant", MERCHANTS) + 1),
            "card_last_four": (draw("card", CARDS) + CARDS_FROM).cast("string"),
            "country": F.get(F.lit(COUNTRIES), draw("country", len(COUNTRIES))),
        }
    )


def train_from(
    spark: SparkSession, data: str, model_path: str, params: training.TrainingParams = training.TrainingParams()
) -> dict[str, DataFrame]:
    """Splits, trains, evaluates on the test part, and saves the model with its metadata."""
    rows = with_row_numbers(read_dataset(spark, data), "row_number")
    split = preparation.stratified_split(rows, LABEL, "row_number")
    model = training.train(split.where(F.col("split") == preparation.TRAIN), params=params)
    held_out = training.score(split.where(F.col("split") == preparation.TEST), model)
    result = evaluation.evaluate(held_out, LABEL)
    save_model(model, f"{model_path}/fitted")
    save_metadata(training.model_metadata(split, result, params=params), f"{model_path}/metadata")
    decided = deciding.decide(written(held_out.select(LABEL, deciding.SCORE), "decided"))
    return {
        "classes": reports.class_profile(rows),
        "parts": reports.split_profile(split),
        "evaluation": result,
        "classification": evaluation.classification_report(decided, LABEL),
        "features": training.top_features(training.feature_importance(spark, model)),
    }


def records_from(spark: SparkSession, data: str) -> DataFrame:
    """The rows of a dataset as keyed records, numbered in file order, stamped with the time of the run."""
    rows = with_parties(with_row_numbers(read_dataset(spark, data), "number"), "number")
    messages = producing.build_messages(
        rows.withColumn("now", F.current_timestamp()), "number", "now", keep=("number", "now")
    )
    return producing.to_keyed_records(messages, "number", keep=("number", "now"))


def send_and_count(spark: SparkSession, keyed: DataFrame, send: Callable[[DataFrame], None], tables: str | None) -> None:
    """Sends records, and with a folder of tables stores how many there were, how many of them frauds, and the time.

    The records are counted on their way out, not read again.
    """
    label = F.get_json_object(F.col("value").cast("string"), f"$.{deciding.ACTUAL}")
    counts, started = Observation("sent"), time.monotonic()
    send(keyed.observe(counts, F.count("*").alias("n"), F.count_if(label == "1").alias("frauds")))
    if tables:
        paths = SinkPaths.under(tables)
        row = batch_row(
            spark,
            SENT,
            batch_size=counts.get["n"],
            actual_count=counts.get["frauds"],
            send_seconds=time.monotonic() - started,
        )
        write_batch(row, paths.sent, int(time.time() * 1000), 1)


def _as_records(keyed: DataFrame, topic: str, partition: Column, offset: Column) -> DataFrame:
    return keyed.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        F.col("now").alias("timestamp"),
    )


def write_records(keyed: DataFrame, folder: str, topic: str = KafkaSettings.input_topic) -> None:
    """Records as Parquet files of Kafka shape, to be read by a file stream."""
    _as_records(keyed, topic, F.spark_partition_id(), F.col("number")).write.mode("append").parquet(folder)


def extend_log(keyed: DataFrame, folder: str, topic: str = KafkaSettings.input_topic) -> None:
    """Records added to a record log, by number in turn to its partitions, behind all that it holds."""
    behind = max((end for _, end in bounds(folder).values()), default=0)
    partition = (F.col("number") % LOG_PARTITIONS).cast("int")
    append_to_log(_as_records(keyed, topic, partition, behind + F.floor(F.col("number") / LOG_PARTITIONS)), folder)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="txnscore", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)

    train = commands.add_parser("train", help="train on a labelled CSV dataset")
    train.add_argument("--data", required=True)
    train.add_argument("--model", required=True)
    train.add_argument("--trees", type=int, default=training.TrainingParams.trees)
    train.add_argument("--depth", type=int, default=training.TrainingParams.depth)

    produce = commands.add_parser("produce", help="send a dataset as transaction messages")
    produce.add_argument("--data", required=True)
    produce.add_argument("--tables", help="where to store how much was sent")
    _add_intake(produce)

    score = commands.add_parser("score", help="score a topic or a folder of records")
    score.add_argument("--model", required=True)
    score.add_argument("--tables", required=True)
    score.add_argument("--checkpoint", required=True)
    score.add_argument("--threshold", type=float, default=FRAUD_THRESHOLD)
    score.add_argument("--interval", type=int, default=BATCH_INTERVAL_SECONDS)
    score.add_argument("--once", action="store_true", help="work off what is there and end")
    score.add_argument("--alert-topic", default=KafkaSettings.alert_topic)
    score.add_argument("--offsets", default=KafkaSettings.starting_offsets, help="where a new checkpoint starts")
    score.add_argument("--intake", type=int, default=KafkaSettings.max_offsets_per_trigger, help="records per batch")
    score.add_argument("--intake-files", type=int, default=FILES_PER_TRIGGER, help="files of records per batch")
    score.add_argument("--min-partitions", type=int, help="least number of tasks that read the topic")
    score.add_argument("--ignore-data-loss", action="store_true")
    _add_intake(score)

    report = commands.add_parser("report", help="print a report over the tables")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--tables", required=True)
    report.add_argument("--rows", type=int, default=20)
    return root


def _add_intake(command: argparse.ArgumentParser) -> None:
    command.add_argument("--topic", default=KafkaSettings.input_topic)
    intake = command.add_mutually_exclusive_group(required=True)
    intake.add_argument("--servers", help="Kafka bootstrap servers")
    intake.add_argument("--records", help="folder of record files instead of a topic")
    intake.add_argument("--log", help="folder of a record log instead of a topic")


def run(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Runs one program; a session that was not handed in is stopped at the end."""
    options = parser().parse_args(arguments)
    if spark is not None:
        return PROGRAMS[options.command](spark, options)
    spark = build_session(f"txnscore-{options.command}")
    try:
        PROGRAMS[options.command](spark, options)
    finally:
        spark.stop()


def _train(spark: SparkSession, options: argparse.Namespace) -> None:
    params = training.TrainingParams(trees=options.trees, depth=options.depth)
    for title, table in train_from(spark, options.data, options.model, params).items():
        log.info(title)
        table.show(truncate=False)


def _produce(spark: SparkSession, options: argparse.Namespace) -> None:
    def send(keyed: DataFrame) -> None:
        if options.servers:
            send_records(keyed.select("key", "value"), KafkaSettings(options.servers, options.topic))
        elif options.log:
            extend_log(keyed, options.log, options.topic)
        else:
            write_records(keyed, options.records, options.topic)

    send_and_count(spark, records_from(spark, options.data), send, options.tables)


def _score(spark: SparkSession, options: argparse.Namespace) -> None:
    scorer = model_scorer(load_model(f"{options.model}/fitted"))
    config = ScoringConfig(threshold=options.threshold, batch_interval_seconds=options.interval)
    if options.servers:
        settings = scoring_settings(options)
        records, senders = kafka_stream(spark, settings), (alert_sender(settings),)
    elif options.log:
        lossless = not options.ignore_data_loss
        records, senders = log_stream(spark, options.log, options.offsets, options.intake, lossless), ()
    else:
        records, senders = record_stream(spark, options.records, options.intake_files), ()
    paths = SinkPaths.under(options.tables)
    # A log limits its batches itself, which a run for what is there would not repeat.
    at_once = options.once and not options.log
    query = start_scoring(records, scorer, paths, options.checkpoint, config, senders, available_now=at_once)
    work_off(query) if options.once and options.log else run_until_stopped(query)


def scoring_settings(options: argparse.Namespace) -> KafkaSettings:
    return KafkaSettings(
        servers=options.servers,
        input_topic=options.topic,
        alert_topic=options.alert_topic,
        max_offsets_per_trigger=options.intake,
        starting_offsets=options.offsets,
        fail_on_data_loss=not options.ignore_data_loss,
        min_partitions=options.min_partitions,
    )


def _report(spark: SparkSession, options: argparse.Namespace) -> None:
    paths = SinkPaths.under(options.tables)
    REPORTS[options.name](spark, paths).show(options.rows, truncate=False)


PROGRAMS = {"train": _train, "produce": _produce, "score": _score, "report": _report}
