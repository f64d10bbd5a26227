"""Quality classifier over document statistics.

Statistics of each whole text go through random Fourier features, which approximate a Gaussian kernel. Ridge
weights come from normal equations that are summed per partition, and an isotonic fit on other rows turns scores
into probabilities. Labels are learned from a bounded sample: the ``sample`` labelled rows with the smallest hash of
their id, outside the held-out fold. One half of them fits the weights, the other half the calibration.

Defined results: a null text is empty, and empty texts are scored like any other. A document with several labels
counts once, with the largest. With no labels, or labels of one class only, every score is that share (0.5 for
none). Rows with the same id each get a result. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.batches import flat, groups
from txnscore.llm.common import fold, whole_text
from txnscore.workspace import written

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BLOCK_BYTES = 4 << 20

_KIND = np.full(256, 7, np.int8)  # other symbols
for _number, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'\"-()", b"!?|")
):
    _KIND[list(_bytes)] = _number
_KIND[128:] = 0
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
STATISTICS = (
    "bytes words lower upper digits spaces lines marks shouts symbols word_bytes repeats distinct distinct_lines"
).split()


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _runs(data: np.ndarray, starts: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes outside ``gap``: the text number, the length and a hash of each."""
    inside = ~gap
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = inside & (edge[:-1] | np.concatenate([[True], gap[:-1]]))
    end = inside & (edge[1:] | np.concatenate([gap[1:], [True]]))
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    powers = np.cumprod(np.full(len(data), 0x9E3779B97F4A7C15, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    back = np.cumprod(np.full(len(data), inverse, np.uint64))
    value = (sums[last] - sums[first]) * back[first]
    value ^= value >> np.uint64(29)
    return np.searchsorted(starts, first, side="right") - 1, last - first, value * np.uint64(0xBF58476D1CE4E5B9)


def _distinct(owner: np.ndarray, value: np.ndarray, count: int) -> np.ndarray:
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return np.bincount(owner[new], minlength=count)


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    count, sizes = len(starts) - 1, np.diff(starts)
    owner = np.repeat(np.arange(count), sizes)
    kinds = np.bincount(owner * 8 + _KIND[data], minlength=8 * count).reshape(count, 8)
    word_of, word_size, word = _runs(data, starts, _SPACE[data])
    line_of, _, line = _runs(data, starts, data == 10)
    words, lines = np.bincount(word_of, minlength=count), np.bincount(line_of, minlength=count)
    again = (word_of[1:] == word_of[:-1]) & (word[1:] == word[:-1])
    return np.column_stack(
        [
            np.log1p(sizes),
            np.log1p(words),
            *[_ratio(kinds[:, k], sizes) for k in range(8)],
            np.log1p(_ratio(np.bincount(word_of, weights=word_size, minlength=count), words)),
            _ratio(np.bincount(word_of[1:][again], minlength=count), words),
            _ratio(_distinct(word_of, word, count), words),
            _ratio(_distinct(line_of, line, count), lines),
        ]
    )


def document_statistics(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` with the statistics of each document as doubles."""
    schema = docs.select(*keys).schema
    for name in STATISTICS:
        schema = schema.add(f"s_{name}", "double")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column(batch.num_columns - 1))
            parts = [np.zeros((0, len(STATISTICS)))]
            for first, last in groups(starts, BLOCK_BYTES):
                part = starts[first : last + 1]
                parts.append(statistics(data[part[0] : part[-1]], part - part[0]))
            values = np.vstack(parts)
            columns = [*batch.columns[:-1], *[pa.array(values[:, k]) for k in range(values.shape[1])]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*keys, whole_text(text_col).cast("binary").alias("_text")).mapInArrow(measure, schema)


@dataclass(frozen=True)
class QualityModel:
    """Weights of the Fourier features and the steps of the calibration."""

    mean: np.ndarray = field(repr=False)
    scale: np.ndarray = field(repr=False)
    directions: np.ndarray = field(repr=False)
    phases: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)
    at: np.ndarray = field(repr=False)
    probability: np.ndarray = field(repr=False)

    def features(self, values: np.ndarray) -> np.ndarray:
        waves = ((values - self.mean) / self.scale) @ self.directions + self.phases
        return np.column_stack([np.cos(waves) * np.sqrt(2 / len(self.phases)), np.ones(len(values))])

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.interp(self.features(values) @ self.weights, self.at, self.probability)


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing fit of the labels over the scores (pool adjacent violators).

    Each block is shrunk by one observation of the overall share, so that no probability is exactly 0 or 1.
    """
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, count, first score, last score
    for x, y in zip(score[order], label[order], strict=True):
        blocks.append([float(y), 1.0, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, count, _, last = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += count
            blocks[-1][3] = last
    share = float(label.mean())
    fitted = [(total + share) / (count + 1) for total, count, _, _ in blocks]
    fitted = np.maximum.accumulate(fitted)
    at = np.array([x for block in blocks for x in block[2:]])
    return at, np.repeat(fitted, 2)


def _start(values: np.ndarray, features: int, width: float, seed: int) -> QualityModel:
    rng, size = np.random.default_rng(seed), values.shape[1]
    scale = values.std(0) if len(values) else np.ones(size)
    return QualityModel(
        mean=values.mean(0) if len(values) else np.zeros(size),
        scale=np.where(scale > 1e-9, scale, 1.0),
        directions=rng.standard_normal((size, features)) / width,
        phases=rng.uniform(0, 2 * np.pi, features),
        weights=np.zeros(features + 1),
        at=np.array([0.0]),
        probability=np.array([0.5]),
    )


def _numbers(frame: pd.DataFrame) -> np.ndarray:
    return frame[[f"s_{name}" for name in STATISTICS]].to_numpy(float)


def train_quality_model(
    measured: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    sample: int = 20_000,
    features: int = 256,
    width: float = 3.0,
    ridge: float = 1e-2,
    partitions: int = 8,
    seed: int = 5,
) -> QualityModel:
    """The model for rows of ``document_statistics``; labels are rows (``id_col``, ``label_col``)."""
    known = (
        labelled.where(F.col(label_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers, so this side has a fixed bound. Of rows with one id, the greatest is taken.
    rows = measured.join(F.broadcast(known), F.col(id_col) == F.col("_id"))
    numbers = F.max(F.struct(*[f"s_{name}" for name in STATISTICS])).alias("numbers")
    rows = rows.groupBy("_id", "_label").agg(numbers).select("_id", "_label", "numbers.*")
    rows = written(
        rows.withColumn("_fit", F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2)) == 0)
        .drop("_id")
        .repartition(partitions),
        "quality-sample",
    )
    count, *sums = rows.agg(
        F.count("*"),
        *[f(F.col(f"s_{name}")) for f in (F.avg, F.stddev_pop) for name in STATISTICS],
    ).first()
    model = _start(np.zeros((0, len(STATISTICS))), features, width, seed)
    if count:
        mean, scale = np.array(sums[: len(STATISTICS)]), np.array(sums[len(STATISTICS) :])
        scale = np.where(scale > 1e-9, scale, 1.0)
        model = QualityModel(mean, scale, model.directions, model.phases, model.weights, model.at, model.probability)

    def sum_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for frame in frames:
            z = model.features(_numbers(frame))
            left += z.T @ z
            right += z.T @ frame["_label"].to_numpy()
        yield pd.DataFrame({"left": [left.ravel()], "right": [right]})

    parts = rows.where("_fit").mapInPandas(sum_up, "left array<double>, right array<double>").collect()
    left = sum((np.array(part["left"]) for part in parts), np.zeros((features + 1) ** 2))
    right = sum((np.array(part["right"]) for part in parts), np.zeros(features + 1))
    left = left.reshape(features + 1, features + 1) + ridge * np.eye(features + 1)
    model = QualityModel(
        model.mean, model.scale, model.directions, model.phases, np.linalg.solve(left, right), model.at, model.probability
    )
    other = rows.where("not _fit").toPandas()
    if len(other):
        at, probability = isotonic(model.features(_numbers(other)) @ model.weights, other["_label"].to_numpy())
        model = QualityModel(model.mean, model.scale, model.directions, model.phases, model.weights, at, probability)
    return model


def score_quality(measured: DataFrame, model: QualityModel, keys: list[str]) -> DataFrame:
    """``keys`` with ``score``, the probability of label 1."""
    schema = measured.select(*keys).schema.add("score", "double")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[keys].assign(score=np.clip(model.score(_numbers(frame)), 0, 1))

    return measured.mapInPandas(score, schema)


def op8_quality(spark: SparkSession, docs: DataFrame, labelled: DataFrame) -> DataFrame:
    measured = written(document_statistics(docs, ["doc_id"]), "statistics")
    model = train_quality_model(measured, labelled)
    return score_quality(measured, model, ["doc_id"]).select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
