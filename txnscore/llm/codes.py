"""Vector code compression: product codes from exact integer clustering over Hilbert-sorted blocks.

A vector is cut into consecutive parts, components become ``floor(1024 * x)``. Each part position has a codebook, which
starts as that part of the vectors with the smallest ids. In every round each part goes to the nearest entry and entries
become the mean of their parts, rounded down; then the parts are assigned once more.

The parts are sorted along a Hilbert curve once and cut into flat blocks that store their box (smallest and largest
value per component) and their sum. In a round, an entry whose smallest distance to a box is above the largest distance
of another can be nearest to none of the block. The entries left are its shortlist: with one, the stored sum is all that
is needed; with more, an exact kernel compares them. Distances are whole numbers throughout: in doubles while everything
stays below 2^53, in 64 bits or in Python's integers beyond. Tasks add up their sums per entry, so a round brings one
row per entry and component to the driver, as many as the codebooks have, however many vectors there are.

Defined results: vectors that are null or hold nulls or non-finite components are dropped, as are those of another
length than the most frequent one (of equally frequent ones the longest). A length that the parts do not divide is cut
at ``floor(p * length / parts)``. Vectors without components get code 0 and error 0 in each part. Components beyond 2^53
count as 2^53, errors beyond 2^63 - 1 as that. Ids may repeat: the first entries then follow the components, equal rows
get equal codes; null ids come last. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.batches import flat
from txnscore.llm.common import addressed, join_groups, numbered, session_settings
from txnscore.workspace import written

SCALE = 1024
LARGEST = 1 << 53
LONGEST = (1 << 63) - 1
BLOCK = 128
#: Readers and workers hold about so many bytes of blocks at a time.
BATCH_BYTES = 64 << 20
#: Bits of a Hilbert key, and deviations from the mean that its grid covers.
KEY_BITS, COVERED = 62, 2.5


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4


def part_bounds(length: int, parts: int) -> list[int]:
    return [p * length // parts for p in range(parts + 1)]


def whole_numbers(vector: Column) -> Column:
    """The components as integers, null where the vector is not to be kept."""
    double = lambda x: x.cast("double")
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(double(x)) < float("inf"), F.lit(False)))
    edge = F.lit(float(LARGEST))
    number = lambda x: F.floor(F.greatest(F.least(double(x) * SCALE, edge), -edge))
    return F.when(sound, F.transform(vector, number))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each cell (a row of coordinates below ``2 ** bits``) on the Hilbert curve."""
    axes = cells.T.astype(np.int64)
    if not len(axes):
        return np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in axes:
            turned = (axis >> bit) & 1 == 1
            swap = np.where(turned, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(turned, below, swap)
            axis ^= swap
    for before, axis in zip(axes[:-1], axes[1:], strict=True):
        axis ^= before
    flip = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    axes ^= flip
    keys = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << 1 | (axis >> bit) & 1
    return keys


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    size = rows.shape[1] * rows.itemsize
    places = pa.array(np.arange(len(rows) + 1, dtype=np.int64) * size)
    data = pa.py_buffer(np.ascontiguousarray(rows))
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, places.buffers()[1], data]).cast(pa.binary())


def _rows_of(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """A binary column as a matrix, a row per value."""
    data, _ = flat(column)
    return data.view(kind).reshape(len(column), width) if width else np.zeros((len(column), 0), kind)


def sub_vectors(vectors: DataFrame, length: int, settings: Settings, mean: float, deviation: float) -> DataFrame:
    """(``part``, ``key``, ``number``, ``body``), a row per vector and part, from (``number``, ``ints``)."""
    bounds = part_bounds(length, settings.parts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, ints = batch.column(0), batch.column(1)
            values = ints.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)
            for part, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                own = values[:, low:high]
                used = own[:, :KEY_BITS]
                bits = max(1, min(8, KEY_BITS // max(1, used.shape[1])))
                share = (used - (mean - COVERED * deviation)) / (2 * COVERED * deviation)
                cells = np.clip(np.floor(share * 2**bits), 0, 2**bits - 1)
                columns = [np.full(len(own), part, np.int32), hilbert_keys(cells, bits)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), numbers, _binary(own)], names=["part", "key", "number", "body"]
                )

    return vectors.select("number", "ints").mapInArrow(cut, "part int, key long, number long, body binary")


def flat_blocks(parts: DataFrame, length: int, settings: Settings) -> DataFrame:
    """Blocks of neighbours on the curve with their boxes and sums.

    Rows are dealt out by ranges of the curve; equal keys by a hash of the row number, so that a vector that fills a
    third of the table fills many tasks.
    """
    bounds = part_bounds(length, settings.parts)
    widths = np.diff(bounds)
    names = ["part", "numbers", "body", "low", "high", "total"]

    def block(part: int, numbers: np.ndarray, values: np.ndarray) -> list:
        box = [edge.astype(np.int64).tobytes() for edge in (values.min(axis=0), values.max(axis=0), values.sum(axis=0))]
        return [part, numbers.tobytes(), values.tobytes(), *box]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = batch.column(0).to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
            rows = []
            for first, last in zip(heads, [*heads[1:], len(owner)], strict=True):
                part = int(owner[first])
                numbers = batch.column(1)[first:last].to_numpy()
                values = _rows_of(batch.column(2)[first:last], int(widths[part]), np.int64)
                rows += [block(part, numbers[k : k + BLOCK], values[k : k + BLOCK]) for k in range(0, len(values), BLOCK)]
            kinds = [pa.int32(), *[pa.binary()] * 5]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=names)

    tied = parts.withColumn("tie", F.xxhash64("number"))
    dealt = tied.repartitionByRange("part", "key", "tie").sortWithinPartitions("part", "key", "tie")
    schema = "part int, numbers binary, body binary, low binary, high binary, total binary"
    return dealt.select("part", "number", "body").mapInArrow(build, schema)


class Codebook:
    """The entries of one part position, and the kernels that compare parts with them."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.peak = int(np.abs(entries).max()) if entries.size else 0
        self.doubles = entries.astype(np.float64)
        self.squares = (self.doubles**2).sum(axis=1)

    def _kind(self, peak: int) -> type:
        """The cheapest numbers in which every distance is exact."""
        most = 4 * max(peak, self.peak, 1) ** 2 * max(1, self.entries.shape[1])
        return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object

    def shortlist(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries that can be nearest to a point of the box, by index."""
        kind = self._kind(int(max(np.abs(low).max(), np.abs(high).max())) if low.size else 0)
        entries = self.doubles if kind is np.float64 else self.entries.astype(kind)
        below, above = low.astype(kind) - entries, entries - high.astype(kind)
        outside = np.maximum(np.maximum(below, above), 0)
        across = np.maximum(np.abs(below), np.abs(above))
        smallest, largest = (outside * outside).sum(axis=1), (across * across).sum(axis=1)
        return np.flatnonzero(smallest <= largest.min())

    def nearest(self, values: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the nearest of the listed entries (the lowest index of equal ones) and its squared distance."""
        kind = self._kind(int(np.abs(values).max()) if values.size else 0)
        if kind is np.float64:
            own = values.astype(np.float64)
            scores = self.squares[listed] - 2 * (own @ self.doubles[listed].T)
            best = scores.argmin(axis=1)
            distance = (own**2).sum(axis=1) + scores[np.arange(len(own)), best]
            return listed[best], distance.astype(np.int64)
        own, entries = values.astype(kind), self.entries[listed].astype(kind)
        best, distance = np.zeros(len(own), np.int64), None
        for k, entry in enumerate(entries):
            apart = ((own - entry) ** 2).sum(axis=1) if own.shape[1] else np.zeros(len(own), kind)
            if distance is None:
                distance = apart
                continue
            closer = apart < distance
            best[closer], distance = k, np.where(closer, apart, distance)
        return listed[best], distance


def _blocks_in(batch: pa.RecordBatch, widths: np.ndarray) -> Iterator[tuple]:
    columns = [batch.column(name) for name in ("part", "numbers", "body", "low", "high", "total")]
    for values in zip(*columns, strict=True):
        part, numbers, body, low, high, total = (value.as_py() for value in values)
        numbers = np.frombuffer(numbers, np.int64)
        rows = np.frombuffer(body, np.int64).reshape(len(numbers), int(widths[part]))
        yield part, numbers, rows, *(np.frombuffer(edge, np.int64) for edge in (low, high, total))


def entry_sums(blocks: DataFrame, books: dict[int, np.ndarray], widths: np.ndarray) -> DataFrame:
    """Sums per part, entry and component over all vectors; component -1 is their number."""
    spark = blocks.sparkSession
    share = spark.sparkContext.broadcast(books)  # as many numbers as the codebooks have

    def emit(part: int, sums: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(sums[:, 0])
        columns = sums.shape[1]
        totals = pa.array([Decimal(int(x)) for x in sums[used].ravel()], pa.decimal128(38, 0))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(used) * columns, part, np.int32)),
                pa.array(np.repeat(used, columns).astype(np.int32)),
                pa.array(np.tile(np.arange(-1, columns - 1), len(used)).astype(np.int32)),
                totals,
            ],
            names=["part", "entry", "place", "total"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {part: Codebook(entries) for part, entries in share.value.items()}
        sums = {part: np.zeros((len(entries), 1 + entries.shape[1]), np.int64) for part, entries in share.value.items()}
        room = dict.fromkeys(known, 1 << 62)
        for batch in batches:
            for part, numbers, rows, low, high, total in _blocks_in(batch, widths):
                most = len(rows) * max(1, int(max(np.abs(low).max(), np.abs(high).max())) if low.size else 1)
                if room[part] < most:
                    yield emit(part, sums[part])
                    sums[part][:], room[part] = 0, 1 << 62
                room[part] -= most
                listed = known[part].shortlist(low, high)
                if len(listed) == 1:
                    sums[part][listed[0], 0] += len(rows)
                    sums[part][listed[0], 1:] += total
                    continue
                chosen, _ = known[part].nearest(rows, listed)
                sums[part][:, 0] += np.bincount(chosen, minlength=len(sums[part]))
                np.add.at(sums[part][:, 1:], chosen, rows)
        for part, found in sums.items():
            yield emit(part, found)

    added = blocks.mapInArrow(add, "part int, entry int, place int, total decimal(38,0)")
    return added.groupBy("part", "entry", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def next_books(blocks: DataFrame, books: dict[int, np.ndarray], widths: np.ndarray) -> dict[int, np.ndarray]:
    """Codebooks after a round; an entry that no part went to stays."""
    found: dict[tuple[int, int], dict[int, int]] = {}
    for part, entry, place, total in entry_sums(blocks, books, widths).collect():
        found.setdefault((part, entry), {})[place] = int(total)
    raised = {part: entries.copy() for part, entries in books.items()}
    for (part, entry), sums in found.items():
        for place in range(int(widths[part])):
            raised[part][entry, place] = sums[place] // sums[-1]
    return raised


def assigned(blocks: DataFrame, books: dict[int, np.ndarray], widths: np.ndarray) -> DataFrame:
    """(``number``, ``part``, ``entry``, ``error``) of every part."""
    share = blocks.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {part: Codebook(entries) for part, entries in share.value.items()}
        for batch in batches:
            for part, numbers, rows, low, high, _ in _blocks_in(batch, widths):
                chosen, error = known[part].nearest(rows, known[part].shortlist(low, high))
                if error.dtype == object:
                    error = np.array([min(int(x), LONGEST) for x in error], np.int64)
                columns = [numbers, np.full(len(rows), part, np.int32), chosen.astype(np.int32), error]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["number", "part", "entry", "error"])

    return blocks.mapInArrow(assign, "number long, part int, entry int, error long")


def books_digest(books: dict[int, np.ndarray]) -> str:
    text = ",".join(str(int(x)) for part in sorted(books) for x in books[part].ravel())
    return hashlib.sha256(text.encode()).hexdigest()


def _reading(width: int) -> dict[str, str]:
    """So few blocks to a batch that wide vectors need no more memory than narrow ones."""
    rows = str(max(1, min(4096, BATCH_BYTES // (8 * BLOCK * (width + 1)))))
    return {"spark.sql.parquet.columnarReaderBatchSize": rows, "spark.sql.execution.arrow.maxRecordsPerBatch": rows}


def _capped(total: Column) -> Column:
    return F.least(total, F.lit(Decimal(LONGEST))).cast("long")


def compress(
    vectors: DataFrame, id_col: str, vector_col: str, settings: Settings = Settings(), keep: tuple[str, ...] = ()
) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Rows (``id``, ``code``, ``error``) and the columns ``keep`` as ``keep0``, ``keep1``...; and the codebooks."""
    kept_names = [f"keep{k}" for k in range(len(keep))]
    rows = vectors.select(
        F.col(id_col).alias("id"),
        whole_numbers(F.col(vector_col)).alias("ints"),
        *[F.col(name).alias(kept) for name, kept in zip(keep, kept_names, strict=True)],
    )
    rows = written(rows.where("ints is not null"), "vectors")
    sizes = rows.groupBy(F.size("ints").alias("length")).count()
    length = (sizes.agg(F.max(F.struct("count", "length"))["length"]).first()[0]) or 0
    rows = numbered(addressed(rows)).where(F.size("ints") == length).withColumnRenamed("_number", "number")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "ints").limit(settings.entries).select("ints").collect()
    bounds = part_bounds(length, settings.parts)
    start = np.array([row["ints"] for row in first], np.int64).reshape(len(first), length)
    books = {p: start[:, low:high] for p, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))}
    if first and length:
        total = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x)
        squares = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        mean, square = rows.agg(F.avg(total) / length, F.avg(squares) / length).first()
        deviation = max(square - mean * mean, 1.0) ** 0.5
    else:
        mean, deviation = 0.0, 1.0
    widths = np.diff(bounds)
    blocks = written(flat_blocks(sub_vectors(rows, length, settings, mean, deviation), length, settings), "blocks")
    with session_settings(vectors.sparkSession, _reading(int(widths.max()))):
        for _ in range(settings.rounds if first else 0):
            books = next_books(blocks, books, widths)
        found = written(assigned(blocks, books, widths), "assigned")
    per_vector = found.groupBy("number").agg(
        *[F.max(F.when(F.col("part") == p, F.col("entry"))).alias(f"entry{p}") for p in range(settings.parts)],
        _capped(F.sum(F.col("error").cast("decimal(38,0)"))).alias("error"),
    )
    digits = max(2, len(f"{settings.entries - 1:x}"))
    code = F.concat(*[F.lower(F.lpad(F.hex(F.col(f"entry{p}")), digits, "0")) for p in range(settings.parts)])
    coded = rows.select("number", "id", *kept_names).join(per_vector, "number")
    return coded.select("id", code.alias("code"), "error", *kept_names), books


def op12_vector_codes(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    coded, books = compress(vectors, "vec_id", "embedding", keep=("label",))
    coded = written(coded, "codes")
    groups = coded.groupBy("keep0").agg(
        F.count("*").alias("size"), _capped(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error")
    )
    return join_groups(coded, written(groups, "label-errors"), "keep0", "size").select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
