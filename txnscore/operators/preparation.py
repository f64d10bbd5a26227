"""Preparing features, splitting by class and weighing classes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscore.functions.decisions import number_or_null
from txnscore.schemas import FEATURES, LABEL, SCALED_FEATURES
from txnscore.workspace import written

PREPARED = "prepared_"
SPLIT_SEED = 42
TEST_FRACTION = 0.2
TRAIN, TEST = "train", "test"

# Accuracy of a median's summary, which sets its size; the rank of the median is then off by some 0.05 %.
SUMMARY_ACCURACY = 2000

# Hex digits of the id hash looked at per counting pass.
_DIGITS_PER_PASS = 3
_HASH_DIGITS = 32
# Classes up to here become a plain expression, further ones a broadcast table, and beyond that a shuffled one.
_WRITTEN_OUT, _BROADCAST_CLASSES = 64, 100_000


@dataclass(frozen=True)
class Scale:
    mean: float
    deviation: float


@dataclass(frozen=True)
class Facts:
    """What training has to know of its rows before the trees: medians, scales, and rows per class."""

    medians: dict[str, float]
    scales: dict[str, Scale]
    legitimate: int
    fraud: int

    @property
    def rows(self) -> int:
        """Rows of both classes."""
        return self.legitimate + self.fraud

    @property
    def fraud_weight(self) -> float:
        """The class ratio, 1 without rows of either class."""
        return self.legitimate / self.fraud if self.fraud and self.legitimate else 1.0


def _scale_columns(cols: Sequence[str]) -> list[Column]:
    known = {name: number_or_null(F.col(name)) for name in cols}
    means = [F.avg(value).alias(f"mean_{name}") for name, value in known.items()]
    return means + [F.stddev_pop(value).alias(f"deviation_{name}") for name, value in known.items()]


def _scales(row, cols: Sequence[str]) -> dict[str, Scale]:
    return {name: Scale(row[f"mean_{name}"] or 0.0, row[f"deviation_{name}"] or 1.0) for name in cols}


def fit_scale(df: DataFrame, cols: Sequence[str] = SCALED_FEATURES) -> dict[str, Scale]:
    """Mean and population deviation per column in one aggregation; NULL and NaN are left out.

    A constant or empty column gets deviation 1, so that scaling it is harmless.
    """
    return _scales(df.agg(*_scale_columns(cols)).first(), cols) if cols else {}


def fit_facts(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    scaled_features: Sequence[str] = SCALED_FEATURES,
    label: str | None = LABEL,
) -> Facts:
    """All facts in one aggregation over one scan.

    Medians come from quantile summaries of a bounded size, which tasks fill side by side and Spark merges on the way. They
    draw nothing at random, unlike sketches compacted by chance: the same rows, read alike, give the same facts.
    """
    to_scale = [name for name in features if name in scaled_features]
    medians = []
    for name in features:
        known = number_or_null(F.col(name))
        medians.append(F.percentile_approx(known, 0.5, SUMMARY_ACCURACY).alias(f"median_{name}"))
    classes = [F.count_if(F.col(label) == value) if label else F.lit(0) for value in (0, 1)]
    row = df.agg(*medians, *_scale_columns(to_scale), classes[0].alias("legitimate"), classes[1].alias("fraud")).first()
    return Facts(
        {name: row[f"median_{name}"] or 0.0 for name in features}, _scales(row, to_scale), row["legitimate"], row["fraud"]
    )


def scaled(value: Column, scale: Scale) -> Column:
    return (value - F.lit(scale.mean)) / F.lit(scale.deviation)


def scale_columns(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    return df.withColumns({name: scaled(F.col(name), scale) for name, scale in scales.items()})


def preparation(facts: Facts) -> SQLTransformer:
    """A pipeline stage that adds ``prepared_*`` columns: medians for missing values, then scaling.

    The facts end up as literals of the stage, so they are saved with the model, and the source columns stay as they
    are.
    """
    prepared = []
    for name, fill in facts.medians.items():
        value = f"coalesce(nanvl(cast(`{name}` as double), cast(null as double)), {fill!r}D)"
        if name in facts.scales:
            value = f"({value} - ({facts.scales[name].mean!r}D)) / {facts.scales[name].deviation!r}D"
        prepared.append(f"{value} AS `{PREPARED}{name}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(prepared)} FROM __THIS__")


def fit_preparation(
    df: DataFrame, features: Sequence[str] = FEATURES, scaled_features: Sequence[str] = SCALED_FEATURES
) -> SQLTransformer:
    """The stage for rows like these."""
    return preparation(fit_facts(df, features, scaled_features, label=None))


def id_hash(identity: Column, seed: int = SPLIT_SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), identity.cast("string")))


def hash_split(
    df: DataFrame, id_col: str, test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED
) -> DataFrame:
    """Split by the hash of an id: no pass over the data, rows with equal ids stay together.

    Each class keeps its share up to chance.
    """
    limit = format(min(int(test_fraction * 16**8), 16**8 - 1), "08x")
    part = F.when(F.substring(id_hash(F.col(id_col), seed), 1, 8) < limit, TEST).otherwise(TRAIN)
    return df.withColumn("split", part)


def part_sizes(sizes: DataFrame, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """(``class``, ``wanted``) from (``class``, ``n``): the test part is rounded up, the train part shared by largest
    remainder, of equal ones to the class that is smaller as text. Rows are classes here."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    train_rows = total - math.ceil(total * test_fraction)
    shared = F.col("n").cast("decimal(38,0)") * F.lit(Decimal(train_rows))
    shares = sizes.select(
        "class",
        "n",
        F.call_function("div", shared, F.lit(Decimal(max(1, total)))).alias("whole"),
        (shared % F.lit(Decimal(max(1, total)))).alias("remainder"),
    )
    left = train_rows - (shares.agg(F.sum("whole")).first()[0] or 0)
    place = F.row_number().over(Window.orderBy(F.col("remainder").desc(), "class"))
    extra = (place <= left).cast("long")
    return shares.select("class", (F.col("n") - F.col("whole") - extra).alias("wanted"))


def _with_small(rows: DataFrame, classes: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by class; a side of few classes, which are counted, is sent to the tasks."""
    return rows.join(F.broadcast(classes) if classes.count() <= _BROADCAST_CLASSES else classes, "class", how)


def _class_name(label: str) -> Column:
    """Classes as text, no label as another one, so that they join like any other value."""
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))


def split_limits(
    df: DataFrame, label: str, id_col: str, test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED
) -> DataFrame:
    """(``class``, ``limit``): the text that the hashes of a class's test rows stay below.

    Each pass counts rows per class and hash prefix and finds, per class, the prefix in which the wanted number of rows
    is reached; the next pass looks three digits further inside that prefix only. All of it stays in Spark: no class is
    gathered in one task, any number of classes goes, and about log4096(rows) + 1 passes are made.
    """
    hashed = df.select(_class_name(label).alias("class"), id_hash(F.col(id_col), seed).alias("hash"))
    sizes = written(hashed.groupBy("class").agg(F.count("*").alias("n")), "class-sizes")
    wanted = written(part_sizes(sizes, test_fraction), "wanted")
    found = wanted.where("wanted = 0").select("class", F.lit("").alias("limit"))
    open_classes = wanted.where("wanted > 0").select("class", F.lit("").alias("prefix"), F.col("wanted").alias("missing"))
    for digits in range(_DIGITS_PER_PASS, _HASH_DIGITS + _DIGITS_PER_PASS, _DIGITS_PER_PASS):
        rows = hashed if digits == _DIGITS_PER_PASS else _with_small(hashed, open_classes).where("startswith(hash, prefix)")
        counts = rows.groupBy("class", F.substring("hash", 1, digits).alias("next")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("class").orderBy("next"))
        reached = counts.withColumn("upto", upto).join(open_classes, "class").where("upto >= missing and upto - n < missing")
        reached = written(reached.select("class", "next", "n", "upto", "missing"), "reached")
        done = (F.col("upto") == F.col("missing")) | F.lit(digits >= _HASH_DIGITS)
        # "g" sorts after every hex digit: all hashes with this prefix are below it.
        found = found.unionByName(reached.where(done).select("class", F.concat("next", F.lit("g")).alias("limit")))
        open_classes = reached.where(~done).select(
            "class", F.col("next").alias("prefix"), (F.col("missing") - F.col("upto") + F.col("n")).alias("missing")
        )
        if open_classes.isEmpty():
            break
    return written(found, "split-limits")


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    id_col: str = "transaction_id",
    test_fraction: float = TEST_FRACTION,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Exact split with the class shares kept: adds ``split``, for few classes as a plain expression on the rows.

    Ids are expected to be unique; copies of an id stay together.
    """
    limits = split_limits(df, label, id_col, test_fraction, seed)
    few = limits.limit(_WRITTEN_OUT + 1).collect()
    if len(few) <= _WRITTEN_OUT:
        limit = F.lit("")
        for name, text in few:
            limit = F.when(_class_name(label) == name, F.lit(text)).otherwise(limit)
        rows = df
    else:
        renamed = limits.withColumnRenamed("limit", "_limit").withColumnRenamed("class", "_class")
        if limits.count() <= _BROADCAST_CLASSES:
            renamed = F.broadcast(renamed)
        rows, limit = df.join(renamed, _class_name(label) == F.col("_class")), F.col("_limit")
    part = F.when(id_hash(F.col(id_col), seed) < limit, TEST).otherwise(TRAIN)
    return rows.select(*df.columns, part.alias("split"))


def class_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Legitimate and fraud rows and their ratio, the weight of a fraud row; NULL without fraud."""
    counts = train.agg(F.count_if(F.col(label) == 0).alias("legitimate"), F.count_if(F.col(label) == 1).alias("fraud"))
    ratio = F.col("legitimate").cast("double") / F.nullif(F.col("fraud").cast("double"), F.lit(0.0))
    return counts.withColumn("scale_pos_weight", ratio)
