"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscore.workspace import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def whole_text(name: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def addressed(docs: DataFrame) -> DataFrame:
    """The rows with ``_file`` and ``_row``, where their content lies.

    Rows that do not come straight from files are written to the shared folder first, so that each has a place.
    """
    place = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    try:
        return docs.withColumns(place)
    except AnalysisException:
        return written(docs, "rows").withColumns(place)


def packed(docs: DataFrame) -> DataFrame:
    """The whole rows as ``row``, beside their ``_file`` and ``_row``, so that no name of theirs meets another."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        return docs.select(F.struct("*").alias("row"), *place)
    except AnalysisException:
        return written(docs, "rows").select(F.struct("*").alias("row"), *place)


#: Rows of one file are numbered in so many bits; files are counted above them.
_ROW_BITS = 40


def numbered(rows: DataFrame) -> DataFrame:
    """``addressed`` rows with ``_number``, another for each row, in the order of file paths and places in the files."""
    nth = F.row_number().over(Window.orderBy("_file")).cast("long").alias("_nth")
    files = written(rows.select("_file").distinct().select("_file", nth), "files")
    number = F.shiftleft("_nth", _ROW_BITS).bitwiseOR(F.col("_row"))
    return rows.join(files, "_file").withColumn("_number", number).drop("_nth")


def free_names(columns: Iterable[str], *names: str) -> dict[str, str]:
    """A name for each of ``names`` that is not among ``columns``, whatever the case of the letters."""
    taken = {name.lower() for name in columns}
    found = {}
    for name in names:
        free = name
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        found[name] = free
    return found


#: A key with at least one in so many rows is hot; there can be no more hot keys than that.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Each row with the columns of its group, nulls being one group; the column ``size`` is dropped.

    ``groups`` has one row per value of ``key`` and in ``size`` its number of rows. The hot groups, at most
    ``HOT_SHARE``, are broadcast, so their rows stay where they are; all others are joined by a shuffle. Both sides
    should be written tables, since they are read twice.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    other, is_hot = free_names([*rows.columns, *groups.columns], "key", "is_hot").values()
    groups = groups.withColumnRenamed(key, other).withColumn(is_hot, F.col(size) * HOT_SHARE >= total).drop(size)
    same = F.col(key).eqNullSafe(F.col(other))
    hot = F.broadcast(groups.where(is_hot))
    in_hot = rows.join(hot, same)
    rest = rows.join(hot, same, "left_anti").join(groups.where(~F.col(is_hot)), same)
    return in_hot.unionByName(rest).drop(other, is_hot)


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the queries that are run inside, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
