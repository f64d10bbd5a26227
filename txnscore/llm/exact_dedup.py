"""Exact deduplication with streamed, disk-backed state.

The digests of all rows are streamed through an aggregation whose state lies in RocksDB and never expires. Per
digest it keeps the row that stays (largest id, then place) with its place, and the number of rows. Afterwards the
rows of a digest are compared by their full bytes: grouped by digest and text, combined in each task before the
shuffle, so that a group of copies costs one row per task. A digest with several texts is split by text.

Defined results: a null text is the empty text. Rows with the same id and text are copies of each other, of which
the one with the last place stays. A null id is smaller than every other. An empty table gives no rows. Columns
beside id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.common import addressed, ascii_lower, packed, session_settings, whole_text
from txnscore.workspace import new_folder, written

#: Settings of the stream: state on disk, with a bound on the memory that all stores of an executor use.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # A store is closed once its part of the batch is committed, so its files lie in the checkpoint only.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def _group() -> list[Column]:
    """The row that stays and the size of a group."""
    return [F.max(F.struct("id", "_file", "_row")).alias("keep"), F.count("*").alias("group_size")]


def full_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _streamed_groups(spark: SparkSession, digests: DataFrame) -> DataFrame:
    """Per digest the row that stays and the number of rows, from the state of a stream over the digest table."""
    path, out, checkpoint = (new_folder(spark, f"dedup-{name}") for name in ("digests", "groups", "state"))
    digests.write.parquet(path)

    def store(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with session_settings(spark, STATE):
        state = (
            spark.readStream.schema(digests.schema)
            .parquet(path)
            .groupBy("digest")
            .agg(*_group())
        )
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
        )
        try:
            query.awaitTermination()
        finally:
            query.stop()
    if not query.lastProgress:
        return digests.groupBy("digest").agg(*_group()).limit(0)
    groups = spark.read.option("basePath", out).parquet(out)
    # Later batches hold later states; both values only grow.
    return groups.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def _duplicates(
    addressed_rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]
) -> DataFrame:
    spark = addressed_rows.sparkSession
    rows = addressed_rows.select(
        F.col(id_col).alias("id"), ascii_lower(whole_text(text_col)).alias("text"), "_file", "_row"
    )
    rows = rows.withColumn("digest", digest(F.col("text")))
    members = rows.select("id", "digest", "_file", "_row")
    groups = _streamed_groups(spark, members)
    # The full bytes of all hits: equal digests are one group only if their texts are one.
    texts = rows.groupBy("digest", "text").agg(F.count("*").alias("_rows"))
    collided = written(
        texts.groupBy("digest").agg(F.count("*").alias("_texts")).where("_texts > 1").select("digest"), "collided"
    )
    result = _with_keeper(members.join(groups, "digest"))
    if not collided.isEmpty():
        apart = rows.join(collided, "digest", "left_semi")
        by_text = apart.groupBy("digest", "text").agg(*_group())
        result = result.join(collided, "digest", "left_anti").unionByName(
            _with_keeper(apart.join(by_text, ["digest", "text"]))
        )
    return result


def _with_keeper(members: DataFrame) -> DataFrame:
    kept = (F.col("_file") == F.col("keep._file")) & (F.col("_row") == F.col("keep._row"))
    return members.select(
        "id", F.col("keep.id").alias("keep_id"), "group_size", kept.alias("kept"), "digest", "_file", "_row"
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = full_digest,
) -> DataFrame:
    """One row per document: ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest``, ``_file`` and ``_row``."""
    return _duplicates(addressed(docs.select(id_col, text_col)), id_col, text_col, digest)


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = packed(docs)
    kept = _duplicates(rows, f"row.{id_col}", f"row.{text_col}", full_digest).where("kept").select("_file", "_row")
    return rows.join(kept, ["_file", "_row"], "left_semi").select("row.*")


def op2_exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    found = exact_duplicates(docs)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )
