"""Audit of how far the sources of a language differ in their words.

A language keeps the terms that occur in enough of its documents. The kept terms, sorted by language and term, are built
into minimal acyclic transducers: a language is a beginning of keys, so each has its terms for itself, and the ordinal
of a key is its place in the order. All texts are then streamed through the transducers, which counts kept terms per
language, source and ordinal; from there on a term is its ordinal, whose order is the order of the terms and settles
ties. A transducer holds a bounded number of terms. A vocabulary beyond that is cut into ranges, each with a transducer
of its own; as many as fit a fixed size are sent to the tasks at a time, and the texts pass through all of them.

Shares are whole billionths, so all sums are exact. Two sources of a language are compared in tiles: up to 64 sources by
1024 terms, dense, where sources lack a term as well as where they have it; sums of tiles are added up by Spark.

Defined results: null text, language or source is the empty text. Repeated rows and ids are documents of their own. A
language without kept terms has distance 0 between its sources and no rows of terms. A source alone in its language has
no pairs. A text of one endless term is one term. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscore.llm import transducer
from txnscore.llm.batches import flat, groups
from txnscore.llm.common import whole_text
from txnscore.workspace import written

#: Runs of letters and of characters beyond ASCII; A-Z is lower-cased before.
TERM = re.compile(rb"[a-z\x80-\xff]+")
BILLION = 1_000_000_000

#: A task gives its counts out beyond so many terms of documents or bytes of them, and so many numbers of a tally.
ENTRIES, ENTRY_BYTES, TALLIED = 1 << 18, 32 << 20, 1 << 20
#: Bytes of text that are looked at together.
STRETCH = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Least number of documents of a kept term, smoothing count, ranks of terms given out.

    ``shard_terms`` and ``shard_bytes`` bound a transducer, ``sent_bytes`` those that are sent to tasks together,
    ``tile`` and ``block`` the sources and terms that are compared together.
    """

    documents: int = 30
    smoothing: int = 5
    ranks: int = 50
    shard_terms: int = 1 << 17
    shard_bytes: int = 16 << 20
    sent_bytes: int = 64 << 20
    tile: int = 64
    block: int = 1024


def language_prefix(lang: str) -> bytes:
    """The beginning of the keys of a language; prefixes order as the languages do, and none begins another."""
    return lang.encode().replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01") + b"\x00"


def terms_of(text: bytes) -> set[bytes]:
    lower = text.lower()
    if len(lower) <= STRETCH:
        return set(TERM.findall(lower))
    return {found[0] for found in TERM.finditer(lower)}


def kept_terms(docs: DataFrame, settings: Settings) -> DataFrame:
    """(``lang``, ``term``) that occur in enough documents, from (``lang``, ``source``, ``body``).

    Tasks count documents per term and give out counts, not terms of documents.
    """

    def emit(counts: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, term, n) for lang, found in counts.items() for term, n in found.items()]
        langs, terms, numbers = zip(*rows, strict=True)
        columns = [pa.array(langs, pa.string()), pa.array(terms, pa.binary()), pa.array(numbers, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        size = held = 0
        for batch in batches:
            for lang, body in zip(batch.column(0), batch.column(1), strict=True):
                found = counts.setdefault(lang.as_py(), Counter())
                before = len(found)
                terms = terms_of(body.as_py())
                found.update(terms)
                if len(found) > before:
                    size += len(found) - before
                    held += sum(map(len, terms))
                if size > ENTRIES or held > ENTRY_BYTES:
                    yield emit(counts)
                    counts, size, held = {}, 0, 0
        if size:
            yield emit(counts)

    counted = docs.select("lang", "body").mapInArrow(count, "lang string, term binary, n long")
    sums = counted.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= settings.documents).select("lang", "term")


SHARD = "id string, first_lang string, first_term binary, langs array<string>, terms array<binary>, size long, bytes long, edges binary, targets binary, before binary, final binary, root int"


def transducers(kept: DataFrame, settings: Settings) -> DataFrame:
    """One row per range of sorted terms: the terms and their transducer."""

    def finish(langs: list[str], terms: list[bytes]) -> pa.RecordBatch:
        made = transducer.build(language_prefix(lang) + term for lang, term in zip(langs, terms, strict=True))
        parts = [array.tobytes() for array in (made.edges, made.targets, made.before, made.final)]
        values = [
            uuid.uuid4().hex, langs[0], terms[0], langs, terms, made.size, sum(map(len, parts)), *parts, made.root
        ]
        kinds = [
            pa.string(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.int64(), pa.int64(),
            *[pa.binary()] * 4, pa.int32(),
        ]
        names = [field.split()[0] for field in SHARD.split(", ")]
        columns = [pa.array([value], kind) for value, kind in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: list[str] = []
        terms: list[bytes] = []
        size = 0
        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if langs and (len(langs) >= settings.shard_terms or size + len(term) > settings.shard_bytes):
                    yield finish(langs, terms)
                    langs, terms, size = [], [], 0
                langs.append(lang)
                terms.append(term)
                size += len(term)
        if langs:
            yield finish(langs, terms)

    ordered = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(build, SHARD)


def _waves(shards: DataFrame, most: int) -> Iterator[list[tuple[int, transducer.Transducer]]]:
    """The transducers, each with the number of terms before it, as many at a time as fit the given bytes."""
    heads = shards.select("id", "size", "bytes").orderBy("first_lang", "first_term").collect()
    offset, at = 0, 0
    while at < len(heads):
        offsets, held = {}, 0
        while at < len(heads) and (not offsets or held + heads[at]["bytes"] <= most):
            offsets[heads[at]["id"]] = offset
            offset, held, at = offset + heads[at]["size"], held + heads[at]["bytes"], at + 1
        rows = shards.where(F.col("id").isin(list(offsets))).select("id", "size", "edges", "targets", "before", "final", "root")
        yield [
            (
                offsets[row["id"]],
                transducer.Transducer(
                    np.frombuffer(row["edges"], np.int64),
                    np.frombuffer(row["targets"], np.int32),
                    np.frombuffer(row["before"], np.int64),
                    np.frombuffer(row["final"], bool),
                    row["root"],
                    row["size"],
                ),
            )
            for row in rows.collect()
        ]


_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[97:123] = _TERM_BYTE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def stretches(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``STRETCH`` bytes (first and last text, bytes, starts); long texts in parts between terms."""
    for first, last in groups(starts, STRETCH):
        own, places = data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        if last - first > 1 or len(own) <= STRETCH:
            yield first, last, own, places
            continue
        at = 0
        while at < len(own):
            stop = min(at + STRETCH, len(own))
            if stop < len(own):
                gaps = np.flatnonzero(~_TERM_BYTE[own[at:stop]])
                if len(gaps):
                    stop = at + int(gaps[-1]) + 1
                else:
                    while stop < len(own) and _TERM_BYTE[own[stop]]:
                        beyond = np.flatnonzero(~_TERM_BYTE[own[stop : stop + STRETCH]])
                        stop = stop + int(beyond[0]) if len(beyond) else min(stop + STRETCH, len(own))
            yield first, last, own[at:stop], np.array([0, stop - at])
            at = stop


class Tally:
    """Counts per group and ordinal within a task."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        found, where = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, where, counts)
        self.keys, self.counts, self.size = [found], [sums], len(found)
        return found, sums


#: Group number above, ordinal below.
_ORDINAL_BITS = 40


def recounted(docs: DataFrame, wave: list[tuple[int, transducer.Transducer]]) -> DataFrame:
    """(``lang``, ``source``, ``ordinal``, ``n``): occurrences of kept terms, all texts streamed through the transducers."""
    share = docs.sparkSession.sparkContext.broadcast(wave)  # at most ``sent_bytes``, or one transducer

    def emit(tally: Tally, names: list[tuple[str, str]]) -> pa.RecordBatch:
        keys, counts = tally.merged()
        group, ordinals = keys >> _ORDINAL_BITS, keys & ((1 << _ORDINAL_BITS) - 1)
        columns = [pa.array([name[k] for name in names], pa.string()).take(pa.array(group)) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(ordinals), pa.array(counts)], names=["lang", "source", "ordinal", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runners = [(offset, transducer.Runner(made)) for offset, made in share.value]
        numbers: dict[tuple[str, str], int] = {}
        begins: list[list[tuple[int, int]]] = []
        tally = Tally()
        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for pair in pairs:
                if pair not in numbers:
                    numbers[pair] = len(numbers)
                    begins.append([runner.start(language_prefix(pair[0])) for _, runner in runners])
            group = np.array([numbers[pair] for pair in pairs], np.int64)
            begin = np.array(begins, np.int64).reshape(len(begins), len(runners), 2)
            data, starts = flat(batch.column(2))
            for first, last, own, places in stretches(_LOWER[data], starts):
                inside = np.concatenate([[False], _TERM_BYTE[own], [False]])
                edge = np.zeros(len(own) + 1, bool)
                edge[places] = True
                head = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
                tail = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
                owner = group[first + np.searchsorted(places, head, side="right") - 1]
                for k, (offset, runner) in enumerate(runners):
                    hit, ordinal = runner.ordinals(own, head, tail, begin[owner, k, 0], begin[owner, k, 1])
                    tally.add(owner[hit] << _ORDINAL_BITS | ordinal + offset)
                if tally.size > 2 * TALLIED:
                    tally.merged()
                if tally.size > TALLIED:
                    yield emit(tally, list(numbers))
                    tally = Tally()
        if tally.size:
            yield emit(tally, list(numbers))

    return docs.select("lang", "source", "body").mapInArrow(count, "lang string, source string, ordinal long, n long")


def share_of(count: Column, total: Column, terms: Column, smoothing: int) -> Column:
    """The smoothed share in whole billionths, plus one."""
    wide = lambda x: x.cast("decimal(19,0)")
    quotient = F.call_function("div", wide(count + smoothing) * F.lit(BILLION).cast("decimal(10,0)"), wide(total + smoothing * terms))
    return F.lit(1).cast("long") + quotient


def group_facts(docs: DataFrame, counts: DataFrame, vocabulary: DataFrame, smoothing: int) -> DataFrame:
    """Per (``lang``, ``source``): occurrences, those of the language, its kept terms and first ordinal, the place of
    the source in its language, and the share of a term that the source lacks."""
    occurring = docs.select("lang", "source").distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.min("ordinal").alias("first"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    facts = occurring.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    facts = facts.select("lang", "source", zero("total"), zero("terms"), zero("first"))
    by_lang = facts.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    lacking = F.when(F.col("terms") > 0, share_of(F.lit(0).cast("long"), F.col("total"), F.col("terms"), smoothing))
    return facts.join(by_lang, "lang").withColumns({"place": place, "lacking": F.coalesce(lacking, F.lit(1))})


def _distances(table: pa.Table, settings: Settings) -> pa.Table:
    """Sums of differences between all sources of two tiles over one block of terms."""
    columns = {name: table.column(name).to_numpy() for name in ("place", "ordinal", "share", "first", "terms", "left", "right")}
    lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
    fill = columns["ordinal"] < 0
    first, terms = int(columns["first"][fill][0]), int(columns["terms"][fill][0])
    begin, end = max(first, block * settings.block), min(first + terms, (block + 1) * settings.block)
    places = np.sort(columns["place"][fill])
    row = np.searchsorted(places, columns["place"])
    shares = np.zeros((len(places), max(0, end - begin)), np.int64)
    shares[row[fill]] = columns["share"][fill][:, None]
    shares[row[~fill], columns["ordinal"][~fill] - begin] = columns["share"][~fill]
    left, right = (np.flatnonzero(places // settings.tile == columns[side][0]) for side in ("left", "right"))
    found = []
    for k in left:
        others = right[right > k]
        if len(others):
            found.append((np.full(len(others), places[k]), places[others], np.abs(shares[others] - shares[k]).sum(axis=1)))
    if not found:
        found.append((np.zeros(0, np.int64),) * 3)
    a, b, value = (np.concatenate(values) for values in zip(*found, strict=True))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": value.astype(np.int64)})


def pair_distances(facts: DataFrame, shares: DataFrame, settings: Settings) -> DataFrame:
    """(``lang``, ``a``, ``b``, ``value``): the summed difference of two sources, by their places, ``a`` below ``b``."""
    block = lambda ordinal: F.floor(ordinal / settings.block)
    blocks = F.sequence(block(F.col("first")), block(F.col("first") + F.greatest(F.col("terms"), F.lit(1)) - 1))
    fills = facts.select("lang", "place", F.explode(blocks).alias("block"), F.lit(-1).cast("long").alias("ordinal"),
                         F.col("lacking").alias("share"), "first", "terms", "sources")
    given = shares.select("lang", "place", block(F.col("ordinal")).alias("block"), "ordinal", "share",
                          "first", "terms", "sources")
    tile, tiles = F.floor(F.col("place") / settings.tile), F.floor((F.col("sources") - 1) / settings.tile)
    paired = fills.unionByName(given).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles)))
    keyed = paired.withColumns({"left": F.least(tile, "other"), "right": F.greatest(tile, "other")})
    tiled = keyed.groupBy("lang", "block", "left", "right")
    sums = tiled.applyInArrow(lambda table: _distances(table, settings), "lang string, a long, b long, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, lang_col: str, source_col: str, text_col: str, settings: Settings = Settings()) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of the pairs of sources and the telling terms."""
    docs = docs.select(
        whole_text(lang_col).alias("lang"), whole_text(source_col).alias("source"), whole_text(text_col).cast("binary").alias("body")
    )
    shards = written(transducers(kept_terms(docs, settings), settings), "transducers")
    offsets = shards.select("id", "size", "first_lang", "first_term")
    before = Window.orderBy("first_lang", "first_term").rowsBetween(Window.unboundedPreceding, -1)
    # One row per transducer.
    offsets = offsets.select("id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    vocabulary = shards.join(offsets, "id").select("offset", F.posexplode(F.arrays_zip("langs", "terms")).alias("at", "key"))
    vocabulary = written(
        vocabulary.select(
            F.col("key.langs").alias("lang"), F.col("key.terms").cast("string").alias("term"), (F.col("offset") + F.col("at")).alias("ordinal")
        ),
        "vocabulary",
    )
    counts = docs.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    for wave in _waves(shards, settings.sent_bytes):
        # No two waves have an ordinal in common.
        sums = recounted(docs, wave).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        counts = counts.unionByName(written(sums, "counts"))
    facts = group_facts(docs, counts, vocabulary, settings.smoothing)
    sources = facts.groupBy("lang").agg(F.count("*").alias("sources"))
    facts = written(facts.join(sources, "lang"), "groups")
    shares = counts.join(facts, ["lang", "source"]).withColumn(
        "share", share_of(F.col("n"), F.col("total"), F.col("terms"), settings.smoothing)
    )
    shares = written(shares.drop("total", "lacking"), "shares")

    distances = written(pair_distances(facts, shares, settings), "distances")
    both = distances.unionByName(distances.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = facts.select("lang", F.col("place").alias("a"), "source")
    items = facts.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    pairs = both.join(names, ["lang", "a"]).join(items, ["lang", "b"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))

    overall = counts.groupBy("ordinal").agg(F.sum("n").alias("lang_n"))
    whole = share_of(F.col("lang_n"), F.col("lang_total"), F.col("terms"), settings.smoothing)
    above = shares.join(overall, "ordinal").withColumn("value", F.col("share") - whole).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal"))
    top = above.select("lang", "source", "ordinal", "value", rank.alias("rank")).where(F.col("rank") <= settings.ranks)
    telling = top.join(vocabulary.select("ordinal", F.col("term").alias("item")), "ordinal")
    return pairs.unionByName(telling.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_source_divergence(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return divergence(docs, "lang", "source", "text")
