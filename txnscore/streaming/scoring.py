"""The scoring job: records in, scores and decisions out, once per trigger."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnscore.config import KafkaSettings, ScoringConfig, SinkPaths
from txnscore.functions.buckets import SCORE as SCORE_BOUNDS
from txnscore.functions.decisions import guarded_ratio
from txnscore.functions.buckets import bucket_counts, cumulative_counts
from txnscore.operators.deciding import ACTUAL, FLAG, SCORE, alerts, decide, transaction_records
from txnscore.operators.parsing import ISSUE, is_storable, parse_records, rejected, storable
from txnscore.operators.training import score
from txnscore.schemas import BATCH_METRICS, BATCH_SERIES, FAILURES
from txnscore.sinks.store import Piece, Store
from txnscore.sinks.tables import alert_table, batch_row, schemas, stage_absent, store_of, stored_batch_id
from txnscore.sinks.topics import alert_sender
from txnscore.sources.records import kafka_stream

Scorer = Callable[[DataFrame], DataFrame]
AlertSender = Callable[[DataFrame, int], None]

# Arrival order of records that share an id.
ORDER = ("partition", "offset")

# What the sinks need of a scored row; the features are left behind before the batch is kept.
KEPT = [
    "transaction_id",
    "Amount",
    ACTUAL,
    "merchant_id",
    "card_last_four",
    "country",
    *ORDER,
    SCORE,
    ISSUE,
    "raw_value",
]


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda messages: score(messages, model)


def scored_records(records: DataFrame, scorer: Scorer, config: ScoringConfig) -> DataFrame:
    """Parse, score and decide as one narrow plan on the executors, for tables and streams alike."""
    return decide(scorer(parse_records(records)).select(*KEPT), config.threshold)


@dataclass(frozen=True)
class BatchFacts:
    """The one row of numbers that reaches the driver per batch."""

    size: int
    flagged: int
    fraud_rate: float
    actual: int
    rejected: int
    first_id: str | None
    last_id: str | None
    score_buckets: list[int]


def batch_facts(scored: DataFrame) -> BatchFacts:
    sound = is_storable()
    identity = F.when(sound, F.col("transaction_id"))
    row = scored.agg(
        F.count_if(sound).alias("size"),
        F.count_if(sound & F.col(FLAG)).alias("flagged"),
        guarded_ratio(F.count_if(sound & F.col(FLAG)), F.count_if(sound)).alias("fraud_rate"),
        F.count_if(sound & (F.col(ACTUAL) == 1)).alias("actual"),
        F.count_if(~sound).alias("rejected"),
        F.min(identity).alias("first_id"),
        F.max(identity).alias("last_id"),
        bucket_counts(cumulative_counts(F.when(sound, F.col(SCORE)), SCORE_BOUNDS)).alias("score_buckets"),
    ).first()
    return BatchFacts(**row.asDict())


#: Sinks may fail side by side; their failures are stored one after the other.
_ONE_FAILURE = threading.Lock()


def store_failure(spark: SparkSession, paths: SinkPaths, sink: str, batch_id: int, error: Exception) -> None:
    """One row per failed attempt at a sink, so repeated attempts at a batch count."""
    name = paths.failures.rsplit("/", 1)[1]
    row = batch_row(spark, FAILURES, failed_batch=batch_id, sink=sink, error=str(error)[:500])
    with _ONE_FAILURE:
        store, number = store_of(spark, paths.failures), time.time_ns()
        store.commit(number, [store.stage(name, row, number, 1)])
        store.compact({name: (FAILURES, None)})


def _watched(
    spark: SparkSession, paths: SinkPaths, sink: str, batch_id: int, write: Callable[[], Piece | None]
) -> Callable[[], Piece | None]:
    """The write, which stores its failure before it fails; if even that cannot be stored, the first error is raised."""

    def attempt() -> Piece | None:
        try:
            return write()
        except Exception as error:
            try:
                store_failure(spark, paths, sink, batch_id, error)
            except Exception as hidden:
                error.add_note(f"the failure could not be stored: {hidden}")
            raise

    return attempt


def _side_by_side(spark: SparkSession, *writes: Callable[[], Piece | None]) -> list[Piece]:
    """Runs independent writes at the same time, so that small jobs do not wait for one another.

    All of them end before this returns; the first failure is raised.
    """
    carry_over = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(writes))) as pool:
        return [found for done in [pool.submit(carry_over(write)) for write in writes] if (found := done.result())]


def process_batch(
    scored: DataFrame,
    batch_id: int,
    paths: SinkPaths,
    alert_senders: tuple[AlertSender, ...] = (),
    store: Store | None = None,
) -> None:
    """Writes one scored batch to all sinks; running it again with the same id changes nothing.

    The batch is scored once, on first use, and kept on the executors; a lost executor's share is scored
    again from the same records. Any failure stops the query before the batch is committed. The tables show the batch
    all at once, when its rows and the rows about it are written and its alerts are sent. All sinks get the same time.
    """
    started = time.monotonic()
    spark = scored.sparkSession
    store = store or store_of(spark, paths.transactions)
    name = lambda path: path.rsplit("/", 1)[1]
    watched = lambda sink, write: _watched(spark, paths, sink, batch_id, write)
    scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = batch_facts(scored)
        inference_seconds = time.monotonic() - started
        writes: list[Callable[[], Piece | None]] = []
        if facts.rejected:
            stage_rejects = lambda: store.stage(name(paths.rejects), rejected(scored), batch_id, facts.rejected)
            writes.append(watched("rejects", stage_rejects))
        if facts.size:
            sound = storable(scored)
            now = F.lit(datetime.now(UTC))
            stored = transaction_records(sound, now, processing_ms=F.lit(inference_seconds * 1000), keep=ORDER)
            if facts.flagged:
                raised = alerts(sound, now)
                stage_alerts = lambda: store.stage(name(paths.alerts), alert_table(raised), batch_id, facts.flagged)
                writes.append(watched("alerts", stage_alerts))
                writes += [watched("alert_topic", lambda send=send: send(raised, batch_id)) for send in alert_senders]
            stage_transactions = lambda: stage_absent(
                store,
                stored,
                paths.transactions,
                batch_id,
                order=ORDER,
                key_range=(facts.first_id, facts.last_id),
                rows=facts.size,
            )
            writes.append(watched("transactions", stage_transactions))
        pieces = _side_by_side(spark, *writes)
        if facts.size:
            elapsed = time.monotonic() - started
            pieces += _side_by_side(
                spark,
                lambda: store.stage(name(paths.batch_metrics), _metrics_row(spark, facts, elapsed), batch_id, 1),
                lambda: store.stage(
                    name(paths.batch_series), _series_row(spark, facts, inference_seconds, elapsed), batch_id, 1
                ),
            )
        if pieces:
            watched("commit", lambda: store.commit(batch_id, pieces))()
            store.compact(schemas(paths))
    finally:
        scored.unpersist()


def _metrics_row(spark: SparkSession, facts: BatchFacts, elapsed: float) -> DataFrame:
    return batch_row(
        spark,
        BATCH_METRICS,
        batch_size=facts.size,
        fraud_count=facts.flagged,
        fraud_rate=facts.fraud_rate,
        processing_ms=elapsed * 1000,
    )


def _series_row(spark: SparkSession, facts: BatchFacts, inference: float, elapsed: float) -> DataFrame:
    return batch_row(
        spark,
        BATCH_SERIES,
        batch_size=facts.size,
        fraud_count=facts.flagged,
        actual_count=facts.actual,
        rejected_count=facts.rejected,
        inference_seconds=inference,
        batch_seconds=elapsed,
        score_buckets=facts.score_buckets,
    )


def start_scoring(
    records: DataFrame,
    scorer: Scorer,
    paths: SinkPaths,
    checkpoint: str,
    config: ScoringConfig = ScoringConfig(),
    alert_senders: tuple[AlertSender, ...] = (),
    available_now: bool = False,
) -> StreamingQuery:
    """Starts the job on a stream of Kafka-shaped records.

    ``checkpoint`` must be on storage that outlives the job: a query started again on it goes on where the
    last one stopped and repeats at most one batch. A new checkpoint is a new run, whose batches lie beside those of
    earlier ones. ``available_now`` works off what is there and ends.
    """
    store = store_of(records.sparkSession, paths.transactions)
    run = store.run_number(checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, stored_batch_id(run, batch_id), paths, alert_senders, store)

    writer = (
        scored_records(records, scorer, config)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{config.batch_interval_seconds} seconds").start()


def run_until_stopped(query: StreamingQuery) -> None:
    """Waits for the query and stops it in order, also on interruption."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def work_off(query: StreamingQuery) -> None:
    """Lets the query take batch after batch until nothing is left to read, and stops it in order.

    For sources with an intake limit of their own, of which a run for what is there would take one batch only.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def score_topic(
    spark: SparkSession,
    model: PipelineModel,
    paths: SinkPaths,
    checkpoint: str,
    settings: KafkaSettings = KafkaSettings(),
    config: ScoringConfig = ScoringConfig(),
) -> StreamingQuery:
    """The job between two Kafka topics: transactions in, alerts out, tables beside."""
    return start_scoring(
        kafka_stream(spark, settings), model_scorer(model), paths, checkpoint, config, (alert_sender(settings),)
    )
