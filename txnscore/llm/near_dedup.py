"""Near-duplicate detection by a chosen-path set similarity join.

A document is the set of its shingles of four words; documents whose sets have a Jaccard similarity of 0.8 or more
are linked, and the groups are the connected components of the links. Equal sets are one member.

Every set has a signature of minwise values. Independent trees branch the members: a path chooses a few of the
signature's places by a hash of the path alone, about 1 / similarity of them, and each chosen place sends a member to
the child named by its value there. Children with one member end. Small nodes are compared exhaustively by their
signatures; larger ones are branched on, and those still large at the deepest level are cut into blocks, of which all
pairs are compared. Pairs alike enough to be possible links tie members into clusters. Inside a cluster the full sets
are counted against each other, exactly; a large cluster is compared by pairs of blocks. Tasks give out only the
links that tie their members together, never all pairs.

Defined results: a null text is empty; a document without words has an empty set and is linked with nothing, one with
fewer than four words has one shingle of all of them. Every row is a document of its own, whatever its id. A component
is named by its smallest id, null being smaller than every other, and that row is kept; of several rows with this id,
the first by place in the files. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.batches import flat, groups, word_runs
from txnscore.llm.common import addressed, numbered, packed, whole_text
from txnscore.llm.components import components
from txnscore.workspace import written

LEAST = -(1 << 63)
BLOCK_BYTES = 2 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity; ``slack`` is by how much a signature may fall below it, 4.5 deviations.

    Clusters of more than ``block`` members or ``shingles`` shingles are compared in parts.
    """

    words: int = 4
    percent: int = 80
    places: int = 128
    trees: int = 20
    levels: int = 3
    node: int = 4096
    block: int = 500
    shingles: int = 4_000_000
    slack: float = 0.16
    seed: int = 3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingles(data: np.ndarray, starts: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    owner, _, hashes = word_runs(data, starts)
    first = np.searchsorted(owner, np.arange(len(starts)))
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(rolled)]
    rolled = _mixed(rolled)
    sets = []
    for low, high in zip(first[:-1], first[1:], strict=True):
        if high - low >= words:
            sets.append(np.unique(rolled[low : high - words + 1]))
        elif high > low:
            whole = np.uint64(high - low)
            for value in hashes[low:high].tolist():
                whole = np.uint64((int(whole) * 0xD6E8FEB86659FD93 + value) % 2**64)
            sets.append(_mixed(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _families(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    return (rng.integers(0, 1 << 31, (settings.places, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, (settings.places, 1), dtype=np.uint32))


def signature(values: np.ndarray, families: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest value of the set under each of the hash functions."""
    factor, shift = families
    x = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        best = np.minimum(best, (x[at : at + 2048] * factor + shift).min(axis=1))
    return best


_SKETCH = "row long, doc long, n_shingles long, h1 long, h2 long, signature binary, brief binary"


def sketches(rows: DataFrame, settings: Settings) -> DataFrame:
    """Rows (``row``, ``doc``, ``body``) as size, identity (128 bits) and signature of their sets.

    ``brief`` has one byte of each value of the signature, enough to estimate how many of two agree.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families = _families(settings)
        for batch in batches:
            data, starts = flat(batch.column(2))
            count, one, two, signs, briefs = [], [], [], [], []
            for low, high in groups(starts, BLOCK_BYTES):
                part = starts[low : high + 1]
                for values in shingles(data[part[0] : part[-1]], part - part[0], settings.words):
                    count.append(len(values))
                    one.append(values.sum(dtype=np.uint64))
                    two.append((values * _MIX1 ^ values >> np.uint64(29)).sum(dtype=np.uint64))
                    sign = signature(values, families)
                    signs.append(sign.tobytes())
                    briefs.append(sign.astype(np.uint8).tobytes())
            identity = [pa.array(np.array(h, np.uint64).view(np.int64)) for h in (one, two)]
            columns = [*batch.columns[:2], pa.array(count, pa.int64()), *identity]
            columns += [pa.array(signs, pa.binary()), pa.array(briefs, pa.binary())]
            names = ["row", "doc", "n_shingles", "h1", "h2", "signature", "brief"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("row", "doc", "body").mapInArrow(sketch, _SKETCH)


def _chosen(paths: np.ndarray, settings: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """For each place of the signature, the rows whose path chooses it."""
    share = 100.0 / (settings.percent * settings.places)
    most = np.uint64(int(share * 2**64))
    for place in range(settings.places):
        yield place, np.flatnonzero(_mixed(paths + np.uint64((place + 1) * 0x9E3779B97F4A7C15 % 2**64)) < most)


def _children(paths: np.ndarray, signs: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and child paths of all rows (path, signature)."""
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for place, chosen in _chosen(paths, settings):
        if len(chosen):
            rows.append(chosen)
            value = signs[chosen, place].astype(np.uint64) << np.uint64(8) | np.uint64(place)
            found.append(_mixed(_mixed(paths[chosen]) + value * np.uint64(0xD6E8FEB86659FD93)))
    return np.concatenate(rows), np.concatenate(found)


_BRANCH = "path long, member long"


def _signs(column: pa.Array, settings: Settings) -> np.ndarray:
    data, _ = flat(column)
    return data.view(np.uint32).reshape(len(column), settings.places)


def branches(members: DataFrame, settings: Settings, paths: bool) -> DataFrame:
    """The children of rows (``member``, ``signature``), from their ``path`` or from the roots of all trees."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = _mixed(np.arange(1, settings.trees + 1, dtype=np.uint64) * np.uint64(settings.seed))
        for batch in batches:
            if not batch.num_rows:
                continue
            member, signs = batch.column(0).to_numpy(), _signs(batch.column(1), settings)
            starts = [batch.column(2).to_numpy().view(np.uint64)] if paths else [
                np.full(len(member), root) for root in roots
            ]
            for at in starts:
                rows, found = _children(at, signs, settings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(member[rows])], names=["path", "member"]
                )

    return members.select("member", "signature", *(["path"] if paths else [])).mapInArrow(branch, _BRANCH)


def chosen_nodes(members: DataFrame, settings: Settings) -> DataFrame:
    """Nodes to compare, as rows (``path``, ``member``); none has more than ``settings.node`` members."""
    found, level = [], branches(members, settings, paths=False)
    for depth in range(settings.levels):
        sizes = level.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        sized = written(level.join(sizes, "path"), "nodes")
        large = sized.where(F.col("size") > settings.node)
        found.append(sized.where(F.col("size") <= settings.node).select("path", "member"))
        if large.isEmpty():
            break
        if depth == settings.levels - 1:
            found.append(_block_pairs(large, "path", "member", F.ceil(2 * F.col("size") / settings.node)))
            break
        level = branches(large.join(members.select("member", "signature"), "member"), settings, paths=True)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def _block_pairs(rows: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """Rows of too large groups, once for every pair of blocks that their block is in; groups get new names."""
    own = F.pmod(F.xxhash64(member, F.lit("block")), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    name = F.xxhash64(group, F.least("_own", "_other"), F.greatest("_own", "_other"), F.lit("pair"))
    cut = rows.withColumn("_blocks", blocks.cast("long")).withColumn("_own", own).withColumn("_other", other)
    return cut.select(name.alias(group), *[c for c in rows.columns if c not in (group, "size")])


def _tied(labels: np.ndarray, rows: np.ndarray) -> None:
    """Gives all labels of the rows, wherever they stand, the smallest of them."""
    old = np.unique(labels[rows])
    if len(old) > 1:
        labels[np.isin(labels, old[1:])] = old[0]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, as tables of whole groups."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        key = table.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None:
        yield rest.combine_chunks()


def _links_of(members: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each member that is tied, with one member of the same label."""
    tied = np.flatnonzero(labels != np.arange(len(labels)))
    return members[tied], members[labels[tied]]


def possible_links(nodes: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """Links (``a``, ``b``) that tie the members of each node whose signatures agree nearly enough."""
    least = (settings.percent / 100 - settings.slack) * settings.places
    short = members.select("member", "brief")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            path, member = table.column(0).to_numpy(), table.column(1).to_numpy()
            signs = flat(table.column(2).combine_chunks())[0].reshape(len(path), settings.places)
            starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
            sizes = np.diff(np.append(starts, len(path)))
            a, b = [], []
            small = np.repeat(sizes <= 4, sizes)
            for apart in range(1, 4):
                rows = np.flatnonzero(small[:-apart] & (path[apart:] == path[:-apart]))
                for at in range(0, len(rows), 20_000):
                    some = rows[at : at + 20_000]
                    alike = (signs[some] == signs[some + apart]).sum(1) >= least
                    a.append(member[some[alike]])
                    b.append(member[some[alike] + apart])
            for start, size in zip(starts[sizes > 4], sizes[sizes > 4], strict=True):
                own, labels = signs[start : start + size], np.arange(size)
                for k in range(size - 1):
                    other = np.flatnonzero(labels[k + 1 :] != labels[k]) + k + 1
                    near = other[(own[other] == own[k]).sum(1) >= least]
                    if len(near):
                        _tied(labels, np.append(near, k))
                left, right = _links_of(member[start : start + size], labels)
                a.append(left)
                b.append(right)
            columns = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])

    return (
        nodes.join(short, "member")
        .select("path", "member", "brief")
        .repartition("path")
        .sortWithinPartitions("path", "member")
        .mapInArrow(compare, "a long, b long")
        .distinct()
    )


def _exactly_tied(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Labels of the sets, equal for those in one component of the exact links."""
    sizes, labels = np.array([len(s) for s in sets]), np.arange(len(sets))
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(value, kind="stable")
    value, owner_by_value = value[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    count = np.diff(np.append(first, len(value)))
    # Of each set, where its shingles' lists of owners are.
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(first)), count)
    begin = np.cumsum(sizes) - sizes
    for k in range(len(sets) - 1):
        own = number[begin[k] : begin[k] + sizes[k]]
        own = own[count[own] > 1]
        lengths = count[own]
        if not len(own):
            continue
        places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths - first[own], lengths)
        common = np.bincount(owner_by_value[places], minlength=len(sets))
        linked = np.flatnonzero(100 * common >= percent * (sizes + sizes[k] - common))
        linked = linked[labels[linked] != labels[k]]
        if len(linked):
            _tied(labels, np.append(linked, k))
    return labels


def exact_links(bodies: DataFrame, settings: Settings) -> DataFrame:
    """Links (``a``, ``b``) that tie the rows (``part``, ``member``, ``body``) of each part by their full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            part, member = table.column(0).to_numpy(), table.column(1).to_numpy()
            data, starts = flat(table.column(2).combine_chunks())
            firsts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            a, b = [], []
            sets: list[np.ndarray] = []
            for low, high in groups(starts, BLOCK_BYTES):
                bytes_of = starts[low : high + 1]
                sets += shingles(data[bytes_of[0] : bytes_of[-1]], bytes_of - bytes_of[0], settings.words)
            for low, high in zip(firsts, np.append(firsts[1:], len(part)), strict=True):
                if high - low > 1:
                    left, right = _links_of(member[low:high], _exactly_tied(sets[low:high], settings.percent))
                    a.append(left)
                    b.append(right)
            columns = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])

    return (
        bodies.select("part", "member", "body")
        .repartition("part")
        .sortWithinPartitions("part", "member")
        .mapInArrow(compare, "a long, b long")
    )


def _found(numbered_rows: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    rows = numbered_rows.select(
        F.col("_number").alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc"),
        whole_text(text_col).cast("binary").alias("body"),
    )
    sketched = written(sketches(rows, settings), "sketches")
    sets = sketched.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("row").alias("member"))
    sets = written(sets, "sets")
    owned = sketched.where("n_shingles > 0").join(sets, ["h1", "h2"])
    members = written(owned.where("row = member").select("member", "signature", "brief", "n_shingles"), "members")
    possible = possible_links(chosen_nodes(members, settings), members, settings)
    clusters = written(components(possible), "clusters")
    # A cluster is as large as its members or its shingles make it, whichever is more.
    weighed = clusters.join(members.select(F.col("member").alias("id"), "n_shingles"), "id")
    sizes = weighed.groupBy("component").agg(
        F.greatest(F.count("*") / settings.block, F.sum("n_shingles") / settings.shingles).alias("size")
    )
    parts = clusters.join(sizes, "component").select(F.col("component").alias("part"), F.col("id").alias("member"), "size")
    whole = parts.where(F.col("size") <= 1).select("part", "member")
    cut = _block_pairs(parts.where(F.col("size") > 1), "part", "member", F.ceil(2 * F.col("size")))
    placed = whole.unionByName(cut.select("part", "member"))
    # The bodies of clustered members are shuffled once by row; only then are they copied to their parts.
    listed = placed.groupBy("member").agg(F.collect_set("part").alias("parts"))
    # Their list grows with the table, so it is never broadcast.
    bodies = rows.join(listed.hint("merge"), F.col("row") == F.col("member")).select(F.explode("parts").alias("part"), "member", "body")
    copies = owned.where("row <> member").select(F.col("row").alias("a"), F.col("member").alias("b"))
    tied = components(exact_links(bodies, settings).unionByName(copies))
    # Links are between rows; the row with the smallest id names the component.
    linked = tied.join(sketched.select("row", "doc"), F.col("id") == F.col("row")).select("row", "doc", "component")
    linked = written(linked, "linked")
    first = linked.groupBy("component").agg(F.min(F.struct("doc", "row")).alias("first"))
    found = sketched.select("row", "doc", "n_shingles").join(
        linked.join(first, "component").select("row", "first"), "row", "left"
    )
    return found.select(
        "row",
        "doc",
        "n_shingles",
        F.coalesce("first.doc", "doc").alias("component"),
        (F.coalesce("first.row", "row") == F.col("row")).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Per row its number ``row``, ``doc`` (the id, ``LEAST`` for null), ``n_shingles``, ``component`` and ``kept``."""
    return _found(numbered(addressed(docs.select(id_col, text_col))), id_col, text_col, settings)


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row of each component, that of the smallest id, with all its columns; of rows with one id, the first."""
    rows = numbered(packed(docs))
    kept = _found(rows, f"row.{id_col}", f"row.{text_col}", settings).where("kept").select(F.col("row").alias("_number"))
    return rows.join(kept, "_number", "left_semi").select("row.*")


def op10_near_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    real = lambda name: F.when(F.col(name) != LEAST, F.col(name))
    return found.select(
        real("doc").alias("doc_id"),
        "n_shingles",
        real("component").alias("component_id"),
        "kept",
    )
