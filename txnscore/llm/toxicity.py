"""Toxicity by noisy-channel deobfuscation.

A trigram model of letters is counted over all texts. Each word of a text is restored under it (see
``deobfuscation``); the restored words and their beginnings are scored by a logistic regression on those that tell
toxic from other texts. These are picked, and their weights fitted, on a bounded sample: the ``sample`` labelled rows
with the smallest hash of their id, outside the held-out fold, one row of each. Scores are calibrated on rows that their
weights have not seen: the sample is cut in parts, each is scored by what the others teach, and a logistic curve over
these scores sets the scale. Equal words are restored once per task.

Defined results: a null text is empty, and empty texts are scored like any other. A document with several labels
counts once, with the largest. With no labels, or labels of one class only, every score is the smoothed share of
label 1. Rows with the same id each get a result. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscore.llm import deobfuscation as noise
from txnscore.llm.common import fold, whole_text
from txnscore.workspace import written

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Words a task remembers before it forgets them all.
CACHED = 300_000


def letter_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter triples over all texts; one row per triple, a fixed number, reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(noise.SIZE**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += noise.trigram_counts(text.as_py().lower())
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["triple", "n"])

    found = docs.select(whole_text(text_col).alias("text")).mapInArrow(count, "triple long, n long")
    counts = np.zeros(noise.SIZE**3, np.int64)
    for row in found.groupBy("triple").agg(F.sum("n").alias("n")).collect():
        counts[row["triple"]] = row["n"]
    return counts


#: Beginnings of words that are features, beside the whole word, which is marked by an end sign.
BEGINNINGS = range(3, 9)
END = "$"


def features(word: str) -> list[str]:
    """The word as a whole and its beginnings; nothing for words with other signs than letters."""
    if not word.isalpha():
        return []
    return [word + END, *[word[:size] for size in BEGINNINGS if len(word) >= size]]


@dataclass(frozen=True)
class ToxicityModel:
    """Letter model, scored features with their weights, and the weight of having none."""

    letters: np.ndarray = field(repr=False)
    words: tuple[str, ...]
    weights: tuple[float, ...]
    base: float


class Reader:
    """Finds scored features in texts; remembers which tokens have none of them."""

    def __init__(self, letters: np.ndarray, words: Sequence[str]) -> None:
        self.number = {word: k for k, word in enumerate(words)}
        whole = {word.removesuffix(END): k for k, word in enumerate(words) if word.endswith(END)}
        self.restorer = noise.Restorer(letters, whole)
        # Words and beginnings that are looked for anywhere in letters written apart, where words are not marked off.
        self.long = [(word.removesuffix(END), k) for k, word in enumerate(words) if len(word.removesuffix(END)) >= 4]
        self.clean: set[str] = set()
        self.hits: dict[str, list[int]] = {}

    def found(self, text: str) -> list[int]:
        text = text.lower()
        tokens = set(text.split())
        for token in tokens - self.clean - self.hits.keys():
            numbers = [self.number[f] for word in self.restorer.words(token) for f in features(word) if f in self.number]
            if numbers:
                self.hits[token] = numbers
            else:
                self.clean.add(token)
        found = {number for token in tokens & self.hits.keys() for number in self.hits[token]}
        for joined in self.restorer.spaced(text):
            found |= {self.number[f] for f in features(joined) if f in self.number}
            found |= {k for word, k in self.long if word in joined}
        for seen in (self.clean, self.hits):
            if len(seen) > CACHED:
                seen.clear()
        return sorted(found)


def _sketch(tokens: list[str]) -> int:
    """The smallest hash of three tokens in a row: copies of a text, edited ones too, mostly share it."""
    runs = zip(tokens, tokens[1:], tokens[2:], strict=False) if len(tokens) > 2 else [tokens]
    return min(zlib.crc32(" ".join(run).encode()) for run in runs)


def restored_features(docs: DataFrame, letters: np.ndarray, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` with the distinct features of the restored words of each text and its ``sketch``."""
    schema = docs.select(*keys).schema.add("features", T.ArrayType(T.StringType())).add("sketch", "long")

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, cache = noise.Restorer(letters), {}
        for batch in batches:
            found, sketches = [], []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py().lower()
                tokens = text.split()
                for token in set(tokens) - cache.keys():
                    cache[token] = [f for word in restorer.words(token) for f in features(word)]
                spaced = [f for word in restorer.spaced(text) for f in features(word)]
                found.append(sorted({f for token in set(tokens) for f in cache[token]} | set(spaced)))
                sketches.append(_sketch(tokens))
                if len(cache) > CACHED:
                    cache.clear()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(pa.string())), pa.array(sketches, pa.int64())],
                names=schema.names,
            )

    return docs.select(*keys, whole_text(text_col).alias("_text")).mapInArrow(restore, schema)


def logistic(
    there: np.ndarray, label: np.ndarray, worth: np.ndarray, ridge: float, passes: int = 25
) -> np.ndarray:
    """Weights, the base last, by Newton's method; each row counts ``worth``."""
    x = np.column_stack([there, np.ones(len(there))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    share = (worth @ label + 0.5) / (worth.sum() + 1)
    w[-1] = np.log(share / (1 - share))
    for _ in range(passes):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (worth * (p - label)) + penalty * w
        bend = (x * (worth * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
    return w


def train_toxicity_model(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = 8_000,
    candidates: int = 2_000,
    most: int = 200,
    least: float = 4.0,
    least_odds: float = 5.0,
    ridge: float = 0.05,
) -> ToxicityModel:
    """The model; a candidate stands in toxic texts worth ``least`` and is there ``least_odds`` times as frequent.

    Texts with the same sketch are worth one together, so that a group of copies does not make its words telling.
    """
    letters = noise.log_probabilities(letter_counts(docs, text_col))
    known = (
        labelled.where(F.col(label_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers, so this side has a fixed bound. Of rows with one id, the largest text is read.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")).join(F.broadcast(known), "_id")
    rows = rows.groupBy("_id", "_label").agg(F.max("_body").alias("_body"))
    rows = written(restored_features(rows, letters, ["_label"], "_body"), "toxicity-sample")
    alike = rows.groupBy("sketch").agg((1 / F.count("*")).alias("worth"))
    rows = rows.join(alike, "sketch").withColumns(
        {"toxic": F.col("worth") * F.col("_label"), "other": F.col("worth") * (1 - F.col("_label"))}
    )
    sums = rows.agg(F.sum("toxic"), F.sum("other")).first()
    toxic, other = (float(value or 0) for value in sums)
    base = float(np.log((toxic + 0.5) / (other + 0.5)))
    if not toxic or not other:
        return ToxicityModel(letters, (), (), base)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    picked = (
        rows.select("toxic", "other", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .withColumn("odds", odds)
        .where((F.col("toxic") >= least) & (F.col("odds") > np.log(least_odds)))
        .orderBy(F.round(F.col("toxic") * F.col("odds"), 6).desc(), "feature")
        .limit(candidates)
        .collect()
    )
    words = [row["feature"] for row in picked]
    if not words:
        return ToxicityModel(letters, (), (), base)
    number = {word: k for k, word in enumerate(words)}
    found = rows.select("_label", "worth", "sketch", F.array_intersect("features", F.lit(words)).alias("features")).collect()
    there = np.zeros((len(found), len(words)))
    for k, row in enumerate(found):
        there[k, [number[word] for word in row["features"]]] = 1
    label, worth = np.array([row["_label"] for row in found], float), np.array([row["worth"] for row in found])
    odds_of = np.array([row["odds"] for row in picked])
    part = np.array([row["sketch"] for row in found]) % PARTS
    kept, w = _weights(words, there, label, worth, odds_of, most, ridge)
    seen = np.full(len(found), np.nan)
    for number_of in range(PARTS):
        inside = part != number_of
        if 0 < label[inside].sum() < inside.sum():
            some, own = _weights(words, there[inside], label[inside], worth[inside], odds_of, most, ridge)
            seen[~inside] = there[~inside][:, some] @ own[:-1] + own[-1]
    slope, shift = _scale(seen, label, worth)
    return ToxicityModel(
        letters, tuple(words[k] for k in kept), tuple(slope * float(x) for x in w[:-1]), slope * float(w[-1]) + shift
    )


#: Parts of the sample that are scored by what the others teach.
PARTS = 4


def _weights(
    words: Sequence[str], there: np.ndarray, label: np.ndarray, worth: np.ndarray, odds: np.ndarray, most: int, ridge: float
) -> tuple[list[int], np.ndarray]:
    kept = telling(words, there, label, worth, odds, most)
    return kept, logistic(there[:, kept], label, worth, ridge)


def _scale(seen: np.ndarray, label: np.ndarray, worth: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from unseen scores to labels; labels count a little less than sure."""
    known = ~np.isnan(seen)
    toxic, other = (worth[known & (label == value)].sum() for value in (1, 0))
    if toxic < 2 or other < 2 or np.ptp(seen[known]) < 1e-9:
        return 1.0, 0.0
    soft = np.where(label == 1, (toxic + 1) / (toxic + 2), 1 / (other + 2))
    slope, shift = logistic(seen[known][:, None], soft[known], worth[known], 1e-3)
    return (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)


def telling(
    words: Sequence[str],
    there: np.ndarray,
    label: np.ndarray,
    worth: np.ndarray,
    odds: np.ndarray,
    most: int,
    least: float = 2.5,
    as_good: float = 0.9,
) -> list[int]:
    """Columns picked one after the other by what the label-1 rows that no earlier one marks are worth, times odds.

    Of a beginning and its continuations that are ``as_good``, the longest is taken.
    """
    open_worth, picked = worth * label, []
    while len(picked) < most:
        marked = open_worth @ there
        gain = np.where(marked >= least, marked * odds, 0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        longer = [k for k in np.flatnonzero(gain >= as_good * gain[best]) if words[k].startswith(words[best])]
        best = max(longer, key=lambda k: len(words[k]))
        picked.append(int(best))
        open_worth *= 1 - there[:, best]
    return picked


def score_toxicity(docs: DataFrame, model: ToxicityModel, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` with ``score``, the probability of label 1."""
    schema = docs.select(*keys).schema.add("score", "double")
    weights = np.array(model.weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.letters, model.words)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sums = np.array([model.base + weights[reader.found(text.as_py())].sum() for text in texts], float)
            scores = 1 / (1 + np.exp(-np.clip(sums, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*keys, "score"])

    return docs.select(*keys, whole_text(text_col).alias("_text")).mapInArrow(score, schema)


def op6_toxicity(spark: SparkSession, docs: DataFrame, labelled: DataFrame) -> DataFrame:
    model = train_toxicity_model(docs, labelled)
    return score_toxicity(docs, model, ["doc_id"]).select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
