"""Relational databases through JDBC."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per insert round trip.
PAGE_ROWS = 500

#: Which batches a table has got; made beside the table, so that rows and mark are one transaction.
_BATCHES = "_batches"
_STAGING = "_staging"


def append_to_database(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Appends rows; uniqueness and replay are the target table's affair. Credentials go into ``options``."""
    _write(df, url, table, "append", options)


def _write(
    df: DataFrame, url: str, table: str, mode: str, options: dict[str, str] | None, types: str | None = None
) -> None:
    settings = {"batchsize": str(PAGE_ROWS), **(options or {})}
    if types:
        settings["createTableColumnTypes"] = types
    df.write.format("jdbc").options(url=url, dbtable=table, **settings).mode(mode).save()


@contextmanager
def _transaction(spark: SparkSession, url: str, options: dict[str, str] | None) -> Iterator[JavaObject]:
    """A connection of the driver, whose statements are all done or none."""
    options = dict(options or {})
    if driver := options.pop("driver", None):
        spark._jvm.java.lang.Class.forName(driver)
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _execute(connection: JavaObject, text: str) -> None:
    statement = connection.createStatement()
    try:
        statement.executeUpdate(text)
    finally:
        statement.close()


def _is_there(connection: JavaObject, text: str) -> bool:
    statement = connection.createStatement()
    try:
        return statement.executeQuery(text).next()
    finally:
        statement.close()


def merge_text(table: str, staging: str, columns: Sequence[str], key: str) -> str:
    """The statement that moves staged rows into a table, those whose key it has left out."""
    names = ", ".join(columns)
    known = f"SELECT 1 FROM {table} t WHERE t.{key} = s.{key}"
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} s WHERE NOT EXISTS ({known})"


def create_batch_marks(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Makes the table of batch marks unless it is there."""
    try:
        with _transaction(spark, url, options) as connection:
            _execute(connection, f"CREATE TABLE {table}{_BATCHES} (batch_id BIGINT NOT NULL PRIMARY KEY)")
    except Py4JJavaError:
        with _transaction(spark, url, options) as connection:
            _is_there(connection, f"SELECT batch_id FROM {table}{_BATCHES} WHERE batch_id = -1")


def merge_into_database(
    df: DataFrame,
    url: str,
    table: str,
    key: str,
    batch_id: int,
    options: dict[str, str] | None = None,
    types: str | None = None,
) -> None:
    """Adds the rows of a batch, unique by ``key``, whose key the table does not have; a replayed batch adds nothing.

    All executors write to a staging table, which is replaced. One transaction on the driver then has the database move the
    rows and marks the batch as done, so a crash leaves either all of the batch or none, and the mark keeps a batch from
    being merged twice. The target table must exist; ``types`` are those of columns whose usual type does not compare.
    """
    spark = df.sparkSession
    done = f"SELECT batch_id FROM {table}{_BATCHES} WHERE batch_id = {batch_id}"
    create_batch_marks(spark, url, table, options)
    with _transaction(spark, url, options) as connection:
        if _is_there(connection, done):
            return
    _write(df, url, table + _STAGING, "overwrite", options, types)
    with _transaction(spark, url, options) as connection:
        # The mark comes first: its key stops a second job that merges the same batch.
        _execute(connection, f"INSERT INTO {table}{_BATCHES} VALUES ({batch_id})")
        _execute(connection, merge_text(table, table + _STAGING, [f'"{name}"' for name in df.columns], f'"{key}"'))
