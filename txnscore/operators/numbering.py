"""Consecutive row numbers without a global sort."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscore.workspace import written

# monotonically_increasing_id keeps the partition above this many bits.
_ROW_BITS = 33


def with_row_numbers(scan: DataFrame, name: str = "row_number") -> DataFrame:
    """Numbers the rows of a scan from 1 on, in the order of file paths and of places in the files.

    The rows are written down with their file, their block of it and their place first. Rows are then counted per
    block, and the counts, one row per block, become offsets that are joined to the rows. How the scan packs files
    into tasks does not matter. Rows that do not come straight from files are numbered by partition.
    """
    place = F.monotonically_increasing_id()
    try:
        placed = scan.withColumns(
            {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_place": place}
        )
    except AnalysisException:
        placed = scan.withColumns({"_file": F.lit(""), "_block": F.shiftright(place, _ROW_BITS), "_place": place})
    placed = written(placed, "numbered")
    blocks = placed.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    offsets = blocks.select("_file", "_block", (before - F.col("_first") + 1).alias("_offset"))
    number = F.col("_place") + F.col("_offset")
    return placed.join(offsets, ["_file", "_block"]).select(*scan.columns, number.alias(name))
