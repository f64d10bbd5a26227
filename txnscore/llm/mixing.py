"""Mixing sources to target weights.

Words are totalled per source in one aggregation. A source's target is ``least(2 * its size, level * its weight)``,
where the level is raised until the targets add up to the wanted share of all words: what capped sources leave
over is shared anew by weight until none is above its cap. A document is then taken ``floor(target / size)`` times,
and once more where a number hashed from its id, text and source falls below the fraction. The hash gives several
independent draws per document; each source uses the draw that comes nearest its target, which is found in one more
aggregation.

Defined results: a null text has no words. Null sources are one source, last in order. Rows that share an id have draws of
their own; rows equal in id, text and source are counted off, and their number goes into the hash, so that a row that
stands there a million times is drawn a million times. A source without words has target 0 and its documents are left
out. An empty table gives no rows. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscore.llm.common import join_groups, packed
from txnscore.workspace import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CAP = 2
#: Draws per document: eight numbers of 32 bits from one digest of the id.
DRAWS = 8


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _seed(id_value: Column, text: Column, source: Column) -> Column:
    known = lambda value: F.coalesce(value.cast("string"), F.lit(""))
    return F.concat(known(id_value), F.lit(":"), F.sha2(text, 256), F.lit(":"), known(source))


def _draws(seed: Column, nth: Column) -> list[Column]:
    """Numbers from 0 up to 1, hashed from the seed and the number among rows with this seed."""
    digest = F.sha2(F.concat(seed, F.lit(":"), nth.cast("string")), 256)
    return [
        F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") / F.lit(float(2**32)) for k in range(DRAWS)
    ]


def source_weights(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Adds ``weight``: the weights in turn, sources by code point, null last.

    The window sees one row per source, numbered inside blocks of equal first two code points.
    """
    blocks = sizes.withColumn("_block", F.substring("source", 1, 2))
    counts = blocks.groupBy("_block").agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.col("_block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_block").alias("_key"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_block").orderBy("source")
    place = F.col("_before") + F.row_number().over(inside) - 1
    cycle = F.array(*[F.lit(int(weight)) for weight in weights])
    return (
        blocks.join(offsets, F.col("_block").eqNullSafe(F.col("_key")))
        .select("source", "source_size", F.element_at(cycle, (place % len(weights) + 1).cast("int")).alias("weight"))
    )


def targets(sizes: DataFrame, share: Fraction = SHARE, cap: int = CAP, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Adds ``weight`` and ``target`` to the rows (``source``, ``source_size``).

    Each pass takes one row of totals to the driver; a pass follows only if the level rose above another cap.
    """
    weighed = written(source_weights(sizes, weights), "weights")
    size, weight = F.col("source_size"), F.col("weight")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = Fraction(0)
    while True:
        # A source is capped when cap * size <= level * weight, in whole numbers.
        capped = cap * size.cast("decimal(38,0)") * level.denominator <= weight.cast("decimal(38,0)") * level.numerator
        row = weighed.where(size > 0).agg(
            F.coalesce(F.sum(F.when(capped, size)), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, weight)), F.lit(0)).alias("open"),
        ).first()
        if not row["open"]:
            break
        raised = (share * total - cap * row["full"]) / row["open"]
        if raised <= level:
            break
        level = raised
    shared = weight * F.lit(float(level.numerator)) / F.lit(float(level.denominator))
    return weighed.withColumn("target", F.least((cap * size).cast("double"), shared))


def sized(rows: DataFrame, id_value: Column, text: Column, source: Column) -> DataFrame:
    """Per row its place, id, source, size and seed, written once; the texts are not read again for the counts."""
    body = F.coalesce(text, F.lit(""))
    return written(
        rows.select(
            "_file",
            "_row",
            id_value.alias("id"),
            source.alias("source"),
            word_count(body).alias("size"),
            _seed(id_value, body, source).alias("seed"),
        ),
        "sizes",
    )


def counted_off(rows: DataFrame) -> DataFrame:
    """(``_file``, ``_row``, ``nth``): rows that share a seed, numbered from 0; rows with a seed of their own are left out.

    They are numbered inside blocks, and each block goes on where the one before ends, so that no task sees all rows
    of a seed.
    """
    groups = written(rows.groupBy("seed").agg(F.count("*").alias("rows")).where("rows > 1"), "repeated")
    if groups.isEmpty():
        return groups.select(F.lit("").alias("_file"), F.lit(0).cast("long").alias("_row"), F.lit(0).cast("long").alias("nth"))
    repeated = join_groups(rows.select("_file", "_row", "seed"), groups, "seed", "rows")
    repeated = repeated.withColumn("block", F.pmod(F.xxhash64("_file", "_row"), F.lit(1024)))
    blocks = repeated.groupBy("seed", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("seed").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("seed", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("seed", "block").orderBy("_file", "_row"))
    numbered = repeated.withColumn("inside", inside).join(blocks, ["seed", "block"])
    return written(numbered.select("_file", "_row", (F.col("before") + F.col("inside") - 1).alias("nth")), "counted-off")


def _with_number(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Adds ``nth``; without repeated rows there is nothing to join."""
    if numbers.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long"))
    return rows.join(numbers, ["_file", "_row"], "left").withColumn("nth", F.coalesce("nth", F.lit(0)))


def mix_plan(rows: DataFrame, **kinds) -> DataFrame:
    """One row per source: its size and target, how often its documents are taken whole and by part, and its draw.

    ``rows`` are sized rows with ``nth``; ``rows`` of the result is the number of documents.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    counts = written(rows.groupBy("source").agg(F.count("*").alias("rows")), "source-rows")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = targets(sizes, **kinds).withColumns({"whole": F.floor(rate), "part": rate - F.floor(rate)})
    wanted = written(wanted.join(counts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of"), "targets")
    drawn = join_groups(rows, wanted, "source", "rows")
    sums = drawn.groupBy("source").agg(
        F.first("target").alias("target"),
        *[
            F.sum(F.col("size") * (F.col("whole") + (draw < F.col("part")).cast("long"))).alias(f"taken{k}")
            for k, draw in enumerate(_draws(F.col("seed"), F.col("nth")))
        ],
    )
    nearest = F.array_min(
        F.array(*[F.struct(F.abs(F.col(f"taken{k}") - F.col("target")), F.lit(k).alias("k")) for k in range(DRAWS)])
    )
    chosen = sums.select(F.col("source").alias("of"), nearest["k"].alias("draw"))
    return written(wanted.join(chosen, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "mix")


def _copies(has_words: Column) -> Column:
    draw = F.element_at(F.array(*_draws(F.col("seed"), F.col("nth"))), F.col("draw") + 1)
    taken = F.col("whole") + (draw < F.col("part")).cast("long")
    return F.when(has_words, taken).otherwise(F.lit(0)).cast("int")


def mixed_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str, **kinds) -> DataFrame:
    """One row per document: ``id``, ``size``, ``source_size``, ``target`` and ``copies``."""
    rows = sized(packed(docs), *[F.col(f"row.{name}") for name in (id_col, text_col, source_col)])
    rows = _with_number(rows, counted_off(rows))
    counted = join_groups(rows, mix_plan(rows, **kinds), "source", "rows")
    return counted.select("id", "size", "source_size", "target", _copies(F.col("size") > 0).alias("copies"))


#: So many sources, of some hundred bytes each, are sent to every task; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kinds
) -> DataFrame:
    """The rows of the mix, each document as often as it is taken."""
    rows = packed(docs)
    id_value, text, source = (F.col(f"row.{name}") for name in (id_col, text_col, source_col))
    slim = sized(rows, id_value, text, source)
    numbers = counted_off(slim)
    plan = mix_plan(_with_number(slim, numbers), **kinds)
    body = F.coalesce(text, F.lit(""))
    rows = _with_number(rows.withColumns({"source": source, "seed": _seed(id_value, body, source)}), numbers)
    if plan.count() <= BROADCAST_SOURCES:
        plan = plan.withColumnRenamed("source", "of")
        rows = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")))
    else:
        rows = join_groups(written(rows, "seeded"), plan, "source", "rows")
    copies = F.array_repeat(F.lit(1), _copies(F.regexp_like(F.coalesce(text, F.lit("")), F.lit(WORD))))
    return rows.select("row", F.explode(copies)).select("row.*")


def op4_mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    counted = mixed_counts(docs.select("doc_id", "text", "source"), "doc_id", "text", "source")
    return counted.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )
