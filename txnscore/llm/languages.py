"""Language identification by a recurrent network over bytes.

The network labels every byte of a text with probabilities; a document gets their mean. Texts are read in pieces of
a fixed number of bytes, the last one ending with the text, and thousands of pieces are labelled at once; every byte
counts once. The network is trained on the driver on a bounded sample: per language, of the most
frequent ones, the ``sample`` rows with the smallest hash of their id, of each a few pieces, padded if the text is shorter. Rows of the held-out fold and rows
without language or without letters are not learned.

Defined results: a null text, and a text without letters, is ``und`` with score 0; with no language to learn all
texts are, and the filter then drops only null texts and texts without letters. Rows with the same id each get a result. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscore.llm import recurrent
from txnscore.llm.batches import flat, groups
from txnscore.llm.common import addressed, fold, packed, whole_text

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
#: Bytes that are labelled at once in a task.
BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: dict[str, np.ndarray] = field(repr=False)
    piece: int


def training_pieces(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int, pieces: int, length: int, languages: int
) -> tuple[tuple[str, ...], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, padded pieces of bytes, the language number and the size of each; at most ``sample * pieces`` per language.

    The bounds of the sample: ``sample`` rows of each of the ``languages`` most frequent languages.
    """
    raw = whole_text(text_col).cast("binary")
    spare = F.greatest(F.length(raw) - length, F.lit(0))
    place = lambda k: (F.pmod(F.xxhash64(F.col(id_col), F.lit(k)), spare + 1) + 1).cast("int")
    learned = F.col(lang_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT)
    rows = addressed(docs.select(*{id_col: 0, text_col: 0, lang_col: 0})).where(learned)
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("rows"))
    # At most ``languages`` rows.
    counts = F.broadcast(counts.orderBy(F.col("rows").desc(), "lang").limit(languages))
    hashed = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("sample")), 1)
    rows = rows.select(
        F.col(lang_col).alias("lang"),
        hashed.alias("h"),
        F.pmod(F.xxhash64("_file", "_row"), F.lit(256)).alias("salt"),
        F.col(text_col).rlike(r"\p{L}").alias("lettered"),
        F.array(*[F.substring(raw, place(k), F.lit(length)) for k in range(pieces)]).alias("bodies"),
    )
    # The smallest hashes lie below this bound, of which few rows are too many to sort.
    near = F.col("h") < F.least(F.lit(16.0 * sample) / F.col("rows"), F.lit(1.0)) * F.lit(2.0**63)
    rows = rows.join(counts, "lang").where(near & F.col("lettered"))
    # Rows that share an id share its hash; salted, they are cut down in many tasks before a language meets in one.
    for keys in (("lang", "salt"), ("lang",)):
        first = Window.partitionBy(*keys).orderBy("h", F.hash("bodies"))
        rows = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample)
    kept = rows.select("lang", "n", "bodies").collect()
    kept.sort(key=lambda row: (row["lang"], row["n"]))
    names = tuple(sorted({row["lang"] for row in kept}))
    found = [
        (np.frombuffer(bytes(body), np.uint8), names.index(row["lang"]))
        for row in kept
        for body in row["bodies"]
    ]
    bodies, sizes = np.zeros((len(found), length), np.uint8), np.array([len(body) for body, _ in found], np.int64)
    for k, (body, _) in enumerate(found):
        bodies[k, : len(body)] = body
    return names, bodies, np.array([number for _, number in found], np.int64), sizes


def train_language_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = 400,
    pieces: int = 4,
    languages: int = 500,
    shape: recurrent.Shape = recurrent.Shape(),
) -> LanguageModel:
    names, bodies, label, sizes = training_pieces(
        docs, id_col, text_col, lang_col, sample, pieces, shape.piece, languages
    )
    weights = recurrent.train(bodies, label, len(names), shape, sizes) if names else {}
    return LanguageModel(names, weights, shape.piece)


def _cut(data: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces (positions x rows), weights and the text number of each: long texts in whole pieces, short ones padded."""
    sizes = np.diff(starts)
    long = np.flatnonzero(sizes >= length)
    if len(long):
        counts = -(-sizes[long] // length)
        owner = np.repeat(long, counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        wanted = nth * length
        at = np.minimum(wanted, sizes[owner] - length)
        places = (starts[owner] + at)[None, :] + np.arange(length)[:, None]
        # A byte that the piece before has labelled already counts nothing.
        weight = (np.arange(length)[:, None] >= (wanted - at)[None, :]).astype(np.float32)
        yield data[places], weight, owner
    short = np.flatnonzero((sizes < length) & (sizes > 0))
    if len(short):
        width = int(sizes[short].max())
        there = np.arange(width)[:, None] < sizes[short][None, :]
        places = np.minimum(starts[short][None, :] + np.arange(width)[:, None], len(data) - 1)
        yield np.where(there, data[places], 0).astype(np.uint8), np.where(there, 1, -1).astype(np.float32), short


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _has_letter(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = sums[starts[1:]] > sums[starts[:-1]]
    for k in np.flatnonzero(~found):
        found[k] = any(map(str.isalpha, data[starts[k] : starts[k + 1]].tobytes().decode("utf-8", "ignore")))
    return found


def probabilities(model: LanguageModel, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean class probabilities of each text; zero for texts without letters."""
    total = np.zeros((len(starts) - 1, len(model.languages)))
    for pieces, weight, owner in _cut(data, starts, model.piece):
        rows = max(1, BLOCK_BYTES // len(pieces))
        for at in range(0, pieces.shape[1], rows):
            cut = slice(at, at + rows)
            np.add.at(total, owner[cut], recurrent.label_positions(model.weights, pieces[:, cut], weight[:, cut]))
    total /= np.maximum(np.diff(starts), 1)[:, None]
    total[~_has_letter(data, starts)] = 0
    return total


def identify(
    docs: DataFrame, model: LanguageModel, keys: list[str], text_col: str = "text"
) -> DataFrame:
    """``keys`` with ``lang_pred`` and ``score``, one row per document."""
    schema = docs.select(*keys).schema.add("lang_pred", "string").add("score", "double")
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column(batch.num_columns - 1))
            pred, score = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows)
            for first, last in groups(starts, 4 * BLOCK_BYTES) if model.languages else ():
                part = starts[first : last + 1]
                p = probabilities(model, data[part[0] : part[-1]], part - part[0])
                best, top = p.argmax(1), p.max(1)
                pred[first:last] = names[np.where(top > 0, best, len(names) - 1)]
                score[first:last] = np.minimum(top, 1.0)
            columns = [*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "lang_pred", "score"])

    return docs.select(*keys, whole_text(text_col).cast("binary").alias("_text")).mapInArrow(label, schema)


def _lettered(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` of the rows whose text has a letter."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = pa.array(_has_letter(*flat(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=keys).filter(there)

    rows = docs.select(*keys, whole_text(text_col).cast("binary").alias("_text"))
    return rows.mapInArrow(pick, docs.select(*keys).schema)


def with_known_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows whose language can be told, with all their columns; texts without letters go."""
    model = train_language_model(docs, id_col, text_col, lang_col)
    rows = packed(docs)
    if model.languages:
        told = identify(rows, model, ["_file", "_row"], f"row.{text_col}").where(F.col("lang_pred") != UNKNOWN)
    else:
        told = _lettered(rows, ["_file", "_row"], f"row.{text_col}")
    return rows.join(told, ["_file", "_row"], "left_semi").select("row.*")


def op3_language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    model = train_language_model(docs)
    told = identify(docs, model, ["doc_id"])
    return told.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
