"""Parquet tables that the scoring job writes batch by batch.

The tables of a job lie in one ``Store``, where a batch shows in all of them at once. Replaying a batch after a crash leaves
every table as if it had run once. Each checkpoint has a run number of its own, which makes up the upper bits of
its batch ids, so that a new checkpoint on the same tables never meets the batches of an earlier one.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnscore.config import SinkPaths
from txnscore.schemas import ALERTS, BATCH_ID, BATCH_METRICS, BATCH_SERIES, REJECTS, TRANSACTIONS
from txnscore.sinks.store import RUN_BITS, Piece, Store

# A batch of at most this many keys (some tens of bytes each) is sent to the tasks that scan stored keys.
BROADCAST_KEYS = 1_000_000

KEY = "transaction_id"


def schemas(paths: SinkPaths) -> dict[str, tuple[StructType, str | None]]:
    """By name, the columns of each table of the scoring job and the key by which merged folders are sorted."""
    return {
        _name(paths.transactions): (TRANSACTIONS, KEY),
        _name(paths.alerts): (ALERTS, None),
        _name(paths.batch_metrics): (BATCH_METRICS, None),
        _name(paths.batch_series): (BATCH_SERIES, None),
        _name(paths.rejects): (REJECTS, None),
    }


def _name(path: str) -> str:
    return path.rsplit("/", 1)[1]


def store_of(spark: SparkSession, path: str) -> Store:
    """The store that the table at ``path`` belongs to."""
    return Store(spark, path.rsplit("/", 1)[0])


def stored_batch_id(run: int, batch_id: int) -> int:
    return (run << RUN_BITS) + batch_id


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return store_of(spark, path).read(_name(path), schema)


def write_batch(df: DataFrame, path: str, batch_id: int, rows: int) -> None:
    """Stores the rows of a batch of one table; what the batch has stored before is replaced."""
    store = store_of(df.sparkSession, path)
    store.commit(batch_id, [store.stage(_name(path), df, batch_id, rows)])


def first_per_key(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of each key along two whole-number columns that are unique together.

    The place of the first row is found by a hash aggregation of one number per key, combined in each task before
    the shuffle; the rows are then joined by key and place, so a key that fills a third of them is spread.
    """
    upper, lower = order
    place = F.col(upper).cast("decimal(10,0)") * F.lit(Decimal(2**64)) + F.col(lower).cast("decimal(20,0)")
    placed = df.withColumn("_place", place)
    first = placed.groupBy(key).agg(F.min("_place").alias("_place"))
    return placed.join(first, [key, "_place"]).select(*df.columns)


def absent_rows(first: DataFrame, others: DataFrame, key: str, key_range: tuple | None, rows: int | None) -> DataFrame:
    """Rows of ``first`` (unique by ``key``) whose key is not among ``others``.

    Stored keys outside the key range of the batch are skipped at the scan by file statistics. A batch known
    to be small is broadcast to the scan of stored keys, which then returns only the keys in common; the
    stored table is not shuffled. A large batch goes through an ordinary shuffled anti join.
    """
    keys = others.select(key)
    if key_range is not None:
        keys = keys.where(F.col(key).between(*map(F.lit, key_range)))
    if rows is not None and rows <= BROADCAST_KEYS:
        keys = keys.join(F.broadcast(first.select(key)), key, "left_semi")
    return first.join(keys, key, "left_anti")


def stage_absent(
    store: Store,
    df: DataFrame,
    path: str,
    batch_id: int,
    schema: StructType = TRANSACTIONS,
    key: str = KEY,
    order: tuple[str, ...] = ("partition", "offset"),
    key_range: tuple | None = None,
    rows: int | None = None,
) -> Piece:
    """Writes the rows whose key no other batch has stored, to be committed; of equal keys the first one wins.

    ``df`` has the columns of ``schema`` and those of ``order``. Rows stored earlier by the same batch do not
    count as present, so a replay writes the same rows again. Only folders whose keys meet the key range of the batch
    are read. ``key_range`` and ``rows`` are bounds for the least and greatest key and the number of keys; they are
    computed when not given.
    """
    first = first_per_key(df, key, order).select(*schema.fieldNames())
    first.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if key_range is None or rows is None:
            facts = first.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")).first()
            key_range, rows = (facts["low"], facts["high"]), facts["n"]
        pieces = [piece for piece in store.pieces(_name(path)) if piece.may_hold(key_range)]
        others = store.read(_name(path), schema, pieces).where(F.col(BATCH_ID) != batch_id)
        return store.stage(_name(path), absent_rows(first, others, key, key_range, rows), batch_id, rows, key_range)
    finally:
        first.unpersist()


def insert_if_absent(df: DataFrame, path: str, batch_id: int, **kinds) -> None:
    """Stores the rows of a batch whose key no other batch has stored, see ``stage_absent``."""
    store = store_of(df.sparkSession, path)
    store.commit(batch_id, [stage_absent(store, df, path, batch_id, **kinds)])


def alert_table(alert_rows: DataFrame) -> DataFrame:
    raised_at = F.timestamp_micros((F.col("timestamp") * 1e6).cast("long"))
    return alert_rows.withColumn("alerted_at", raised_at).select(*ALERTS.fieldNames())


def batch_row(spark: SparkSession, schema: StructType, **values) -> DataFrame:
    """One row about a batch."""
    values["processed_at"] = F.current_timestamp()
    cells = [F.lit(values.get(field.name)).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).select(*cells)
