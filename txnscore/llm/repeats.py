"""Removal of repeated byte strings by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts earlier (in a smaller id, or in the same
document before) is removed. Three steps keep the sorting small without missing a repeat:

1. Each window of ``length`` bytes is put to the anchor in it: the byte run of ``GRAM`` bytes with the smallest hash,
   the first of several. Equal windows have equal anchors. Neighbouring windows with one anchor are one context, about
   one in forty bytes. Contexts go to the task of their anchor, where those met by nothing else drop out, and equal
   contexts count once: all but the first are repeats as they are. Copies met close together are combined before.
2. Different contexts of one anchor may share some windows. Their bytes are gathered per anchor, windows whose hash no
   other one has are left out, and a suffix array of the rest is built by two-stage sorting; neighbours with a common
   prefix of ``length`` bytes are equal windows. An anchor with very many contexts has them cut into pieces by longer
   anchors, first of all but 28 and then of all but 8 bytes of a window, and again pieces met by nothing else drop
   out and equal pieces count once. One that is crowded still is split into its windows, which are dealt out by a hash of
   all their bytes, and those of one hash are sorted in chunks of bounded size: a chunk marks its repeats and sends the
   first of each window on to the next level, until one chunk is left. So a passage may stand in any number of
   documents, whatever surrounds it.
3. The repeated windows of a document, as runs, are cut out of its text.

Defined results: a null text is empty. Texts shorter than ``length`` stay whole. A null id is smaller than every
other; rows with the same id are in the order of their place in the files, told apart by its number. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.batches import flat, groups
from txnscore.llm.common import addressed, numbered, whole_text
from txnscore.llm.suffixes import common_prefixes, suffix_order
from txnscore.workspace import written

LENGTH = 100
GRAM = 24
#: Window starts that are hashed at once.
CHUNK = 1 << 16
#: Texts whose equal contexts are combined before the shuffle.
GROUP_BYTES = 16 << 20
#: Contexts of one anchor that are sorted together, by how many bytes less than a window the anchors of crowded ones
#: are cut anew, into how many more parts the windows of one that is crowded still are dealt, and bytes of a suffix array.
MOST_CONTEXTS = 4000
LESS = (28, 8)
FINER = 16
UNIT_BYTES = 1 << 19
#: Contexts of crowded anchors that are split at once.
SPLIT_ROWS = 2000
#: A place is start << 7 | windows; this many windows mark a run of repeats.
RUN = 127
RUN_BITS = 7
LEAST = -(1 << 63)

_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on."""
    count, part, size, done = len(symbols) - gram + 1, symbols, 1, 0
    whole = np.zeros(count, np.uint64)
    while True:
        if gram & size:
            whole *= _power(size)
            whole += part[done : done + count]
            done += size
        if 2 * size > gram:
            return _mixed(whole)
        part = part[:-size] * _power(size) + part[size:]
        size *= 2


@cache
def _powers(base: int, count: int) -> np.ndarray:
    return np.cumprod(np.full(count, base, np.uint64))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    count, size = len(values) - width + 1, 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:count], values[width - size : width - size + count])


def contexts(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Contexts of all texts: text number, start in the text, windows, anchor hash, hash of the whole context."""
    total = len(data)
    ends = starts[1:]
    lasts = np.maximum(ends - length + 1, starts[:-1])
    found: list[tuple[np.ndarray, ...]] = []
    for low in range(0, total - length + 1, CHUNK):
        high = min(low + CHUNK, total - length + 1)
        text = np.arange(np.searchsorted(ends, low, side="right"), np.searchsorted(starts[:-1], high))
        # Where the windows of each text begin and end here.
        begins, stops = np.maximum(starts[text], low) - low, np.minimum(lasts[text], high) - low
        has = begins < stops
        text, begins, stops = text[has], begins[has], stops[has]
        if not len(text):
            continue
        symbols = _TABLE[data[low : high + length - 1]]
        hashes = _gram_hashes(symbols, gram)
        tagged = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        anchor = _smallest(tagged, length - gram + 1)
        new = np.ones(high - low, bool)
        new[1:] = anchor[1:] != anchor[:-1]
        new[begins] = True
        inside = np.zeros(high - low + 1, np.int8)
        inside[begins] += 1
        inside[stops] -= 1
        begin = np.flatnonzero(new & np.cumsum(inside, dtype=np.int8)[:-1].view(bool))
        of = np.searchsorted(begins, begin, side="right") - 1
        windows = np.minimum(np.append(begin[1:], high - low), stops[of]) - begin
        a, t = (anchor[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64), text[of]
        powers, back = (_powers(base, CHUNK + length)[: len(symbols)] for base in (_BASE, _INVERSE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols * powers)])
        whole = (sums[begin + windows + length - 1] - sums[begin]) * back[begin]
        whole += (a - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + windows.astype(np.uint64)
        found.append((t, begin + low - starts[t], windows, hashes[a], _mixed(whole)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def merged_runs(*columns: np.ndarray) -> list[np.ndarray]:
    """Runs of windows as (owner columns..., start, windows), those that touch or overlap put together, in order."""
    *owners, start, windows = columns
    order = np.lexsort((start, *reversed(owners)))
    owners, start, windows = [owner[order] for owner in owners], start[order], windows[order]
    if not len(start):
        return [*owners, start, windows]
    other = np.ones(len(start), bool)
    other[1:] = np.any([owner[1:] != owner[:-1] for owner in owners], axis=0)
    group = np.cumsum(other)
    # The reach so far within an owner: groups are lifted above each other, so that one running maximum does.
    lift = group * (int((start + windows).max()) + 1)
    reach = np.maximum.accumulate(start + windows + lift)
    new = other.copy()
    new[1:] |= start[1:] + lift[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return [*[owner[first] for owner in owners], start[first], (reach - lift)[last] - start[first]]


_ANCHORED = "key long, ctx long, doc long, tie long, place long"


def _anchored(rows: DataFrame, length: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column(2))
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for low, high in groups(starts, GROUP_BYTES):
                part = starts[low : high + 1]
                columns = combined(data[part[0] : part[-1]], part - part[0], ids[low:high], ties[low:high])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "ctx", "doc", "tie", "place"])

    def combined(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> list[np.ndarray]:
        text, start, windows, key, ctx = contexts(data, starts, length)
        doc, tie = ids[text], ties[text]
        # The contexts of a text come in order, so texts are put in order and then, each staying behind those before it, contexts.
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((ties, ids))] = np.arange(len(ids))
        order = np.argsort(rank[text], kind="stable")
        order = order[np.argsort(ctx[order], kind="stable")]
        key, ctx = key[order], ctx[order]
        again = np.zeros(len(order), bool)
        again[1:] = (key[1:] == key[:-1]) & (ctx[1:] == ctx[:-1])
        once, more = order[~again], order[again]
        d, t, s, w = merged_runs(doc[more], tie[more], start[more], windows[more])
        return [
            np.concatenate([key[~again].view(np.int64), ((d * 31 + t) * 31 + s) * np.int64(0x9E3779B97F4A7C1)]),
            np.concatenate([ctx[~again].view(np.int64), w]),
            np.concatenate([doc[once], d]),
            np.concatenate([tie[once], t]),
            np.concatenate([start[once] << RUN_BITS | windows[once], s << RUN_BITS | RUN]),
        ]

    return rows.select("doc", "tie", "body").mapInArrow(cut, _ANCHORED)


_MARKS = "doc long, tie long, start long, windows long, key long"


def _resolved(anchored: DataFrame) -> DataFrame:
    """Runs of repeats (null key) and, with their key, contexts that share an anchor with a different context.

    Rows come in the order of key, context and place, so a row is a repeat if the row before is the same context.
    Of an anchor's first context, the first row is held back until another context shows.
    """

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int] | None = None  # key and context of the row before
        held: tuple[int, ...] | None = None  # the first row of the current key, while it is alone
        for batch in batches:
            key, ctx, doc, tie, place = (column.to_numpy() for column in batch.columns)
            if not len(key):
                continue
            run = (place & RUN) == RUN
            new_key = np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            same = np.zeros(len(key), bool)
            same[1:] = ~new_key[1:] & (ctx[1:] == ctx[:-1])
            if last is not None:
                new_key[0] = key[0] != last[0]
                same[0] = not new_key[0] and ctx[0] == last[1]
            group = np.cumsum(new_key)
            others = np.bincount(group[~same & ~new_key & ~run], minlength=group[-1] + 1)
            edge = ~same & ~run & (~new_key | (others[group] > 0))
            out = [doc, tie, place >> RUN_BITS, np.where(run, ctx, place & RUN)]
            keep = run | same | edge
            parts = [[column[keep] for column in out] + [key[keep], (same | run)[keep]]]
            if held is not None and others[0]:
                parts.append([np.array([value]) for value in (*held, last[0], False)])
                held = None
            if group[-1] > group[0] or new_key[0]:
                held = None
                first = int(np.flatnonzero(new_key)[-1])
                if not others[group[-1]] and not run[first]:
                    held = tuple(int(column[first]) for column in out)
            last = int(key[-1]), int(ctx[-1])
            columns = [np.concatenate(column) for column in zip(*parts, strict=True)]
            repeat = columns.pop()
            arrays = [pa.array(column) for column in columns[:4]] + [pa.array(columns[4], mask=repeat.astype(bool))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "tie", "start", "windows", "key"])

    return (
        anchored.repartition("key")
        .sortWithinPartitions("key", "ctx", "doc", "tie", "place")
        .mapInArrow(resolve, _MARKS)
    )


_CONTEXTS = "key long, sub int, parts int, doc long, tie long, start long, body binary"
_PIECES = "key long, ctx long, doc long, tie long, start long, windows long, body binary"


def _window_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place on."""
    powers, back = (_powers(base, 1 << len(text).bit_length())[: len(text)] for base in (_BASE, _INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[text] * powers)])
    return _mixed((sums[length:] - sums[:-length]) * back[: len(text) - length + 1])


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    return np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)


def _parts_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """Ranges of the bytes as a binary column."""
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data[_ranges(begin, size)])])


def _cut_finer(edges: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts (``key``, ``parts``, ``doc``, ``tie``, ``start``, ``body``), those of crowded anchors as pieces.

    The windows of a piece have the same smallest ``gram`` bytes; other contexts have no ``ctx``.
    """
    names = [field.split()[0] for field in _PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crowded = pa.array(batch.column(1).to_numpy() > 1)
            key, _, doc, tie, start, body = batch.filter(pc.invert(crowded)).columns
            none = pa.nulls(len(key), pa.int64())
            yield pa.RecordBatch.from_arrays([key, none, doc, tie, start, none, body], names=names)
            many = batch.filter(crowded)
            if not many.num_rows:
                continue
            key, _, doc, tie, start, body = many.columns
            data, starts = flat(body)
            text, at, windows, piece, ctx = contexts(data, starts, length, gram)
            key, doc, tie, start = (column.to_numpy()[text] for column in (key, doc, tie, start))
            key = _mixed(key.view(np.uint64) * np.uint64(_BASE) + piece).view(np.int64)
            columns = [pa.array(c) for c in (key, ctx.view(np.int64), doc, tie, start + at, windows)]
            columns.append(_parts_of(data, starts[text] + at, windows + length - 1))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return edges.mapInArrow(cut, _PIECES)


def _crowded_parts(count: Column, most: int) -> Column:
    """Into how many parts the windows of an anchor with so many contexts are dealt, 1 unless it is crowded."""
    parts = F.least(F.ceil(count * FINER / most), F.lit((1 << 31) - 1)).cast("int")
    return F.when(count > most, parts).otherwise(1).alias("parts")


def _finer(edges: DataFrame, length: int, gram: int, most: int) -> tuple[DataFrame, DataFrame, bool]:
    """Crowded anchors by longer byte runs: runs of repeats, the contexts that are left, and whether one is crowded still.

    As with the first anchors, pieces met by nothing else drop out and equal pieces count once.
    """
    cut = written(_cut_finer(edges, length, gram), "finer")
    pieces = cut.where("ctx is not null")
    first = F.min(F.struct("doc", "tie", "start", "windows", "body")).alias("first")
    alike = written(pieces.groupBy("key", "ctx").agg(first, F.count("*").alias("rows")), "alike")
    met = alike.groupBy("key").agg(F.count("*").alias("count")).where("count > 1")
    met = written(met.select("key", _crowded_parts(F.col("count"), most)), "crowded")
    first = alike.where("rows > 1").select("key", "ctx", F.struct("first.doc", "first.tie", "first.start").alias("first"))
    runs = pieces.join(first, ["key", "ctx"]).where(F.struct("doc", "tie", "start") != F.col("first"))
    left = alike.join(met, "key").select("key", "parts", "first.doc", "first.tie", "first.start", "first.body")
    plain = cut.where("ctx is null").select("key", F.lit(1).alias("parts"), "doc", "tie", "start", "body")
    crowded = not met.where("parts > 1").isEmpty()
    return runs.select("doc", "tie", "start", "windows"), plain.unionByName(left), crowded


def _split(edges: DataFrame, length: int) -> DataFrame:
    """Contexts (``key``, ``parts``, ``doc``, ``tie``, ``start``, ``body``), those of crowded anchors as single windows.

    A window belongs to the part that its hash gives, as ``sub``.
    """
    names = [field.split()[0] for field in _CONTEXTS.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crowded = pa.array(batch.column(1).to_numpy() > 1)
            key, parts, doc, tie, start, body = batch.filter(pc.invert(crowded)).columns
            sub = pa.array(np.zeros(len(key), np.int32))
            yield pa.RecordBatch.from_arrays([key, sub, parts, doc, tie, start, body], names=names)
            many = batch.filter(crowded)
            for low in range(0, many.num_rows, SPLIT_ROWS):
                key, parts, doc, tie, start, body = many.slice(low, SPLIT_ROWS).columns
                data, starts = flat(body)
                windows = np.diff(starts) - length + 1
                row, place = np.repeat(np.arange(len(windows)), windows), _ranges(starts[:-1], windows)
                key, parts, doc, tie, start = (column.to_numpy()[row] for column in (key, parts, doc, tie, start))
                sub = (_window_hashes(data, length)[place] % parts.astype(np.uint64)).astype(np.int32)
                columns = [pa.array(c) for c in (key, sub, parts, doc, tie, start + place - starts[row])]
                columns.append(_parts_of(data, place, np.full(len(place), length)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return edges.mapInArrow(cut, _CONTEXTS)


def _met(text: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Which windows have a hash that another one has, too; no other window can be equal to one."""
    hashes = _window_hashes(text, length)[place]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    met = np.zeros(len(place), bool)
    met[order[1:][same]] = True
    met[order[:-1][same]] = True
    return met


def repeated_windows(
    text: np.ndarray, starts: np.ndarray, doc: np.ndarray, tie: np.ndarray, begin: np.ndarray, length: int
) -> tuple[list[np.ndarray], np.ndarray]:
    """Runs (doc, tie, start, windows) of the windows that also start earlier in one of the contexts, and the contexts
    that have a window which does not.

    Contexts lie in ``text`` one after the other and begin at ``begin`` of their document. Windows whose hash no other
    one has are left out before the sorting.
    """
    windows = np.diff(starts) - length + 1
    row, place = np.repeat(np.arange(len(windows)), windows), _ranges(starts[:-1], windows)
    met = _met(text, place, length)
    alone = row[~met]
    row, place = row[met], place[met]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(place)))
    at = _ranges(place[first], windows + length - 1)
    row = np.repeat(row[first], windows + length - 1)
    text = text[at]
    # Of each stretch, the last places begin no window.
    starting = np.ones(len(text), bool)
    ends = np.cumsum(windows + length - 1)
    starting[_ranges(ends - length + 1, np.full(len(ends), length - 1))] = False
    order = suffix_order(text, length + 4)
    order = order[starting[order]]
    group = np.cumsum(common_prefixes(text, order, length) < length)
    of = row[order]
    start = begin[of] + at[order] - starts[of]
    # Documents in order, each lifted above the one before, so that one number orders all places.
    by = np.lexsort((tie, doc))
    other = np.ones(len(by), bool)
    other[1:] = (doc[by[1:]] != doc[by[:-1]]) | (tie[by[1:]] != tie[by[:-1]])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(other) - 1
    lift = rank[of] * (int(start.max(initial=0)) + 1) + start
    sort = np.lexsort((lift, group))
    group, lift, start, of = group[sort], lift[sort], start[sort], of[sort]
    # Later than the first of its group; the same place may come with several contexts.
    first = np.searchsorted(group, group)
    later = lift != lift[first]
    number, start, windows = merged_runs(rank[of[later]], start[later], np.ones(int(later.sum()), np.int64))
    owner = by[other][number]
    return [doc[owner], tie[owner], start, windows], np.unique(np.concatenate([alone, of[np.unique(first)]]))


_SORTED = "doc long, tie long, start long, windows long, key long, sub int, parts int, body binary"


def _chunks_sorted(contexts_of: DataFrame, length: int, most: int) -> DataFrame:
    """Runs of repeats within each chunk, and, with null ``windows``, what chunks send on to the next level.

    Rows with more than one part are in that many chunks, by a hash of their place.
    """
    names = [field.split()[0] for field in _SORTED.split(", ")]
    kinds = [*[pa.int64()] * 5, *[pa.int32()] * 2, pa.binary()]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            *keys, body = (pa.concat_arrays(columns) for columns in zip(*(batch.columns for batch in held), strict=True))
            key, sub, parts, _, doc, tie, start = (column.to_numpy() for column in keys)
            text, starts = flat(body)
            runs, left = repeated_windows(text, starts, doc, tie, start, length)
            left = left[parts[left] > 1]
            sent = [doc, tie, start, None, key, sub, -(-parts // most), body]
            columns = [
                pa.concat_arrays([
                    pa.nulls(len(runs[0]), kind) if run is None else pa.array(run, kind),
                    pa.nulls(len(left), kind) if column is None else pa.array(column[left], kind) if column is not body else body.take(pa.array(left)),
                ])
                for run, column, kind in zip([*runs, *[None] * 4], sent, kinds, strict=True)
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([column.to_numpy().astype(np.int64) for column in batch.columns[:4]])
            new = np.ones(batch.num_rows, bool)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
            new[0] = last is not None and (keys[:, 0] != last).any()
            groups_at = np.flatnonzero(new)
            reach = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.binary_length(batch.column(7)).to_numpy())])
            low = 0
            # A unit ends with the group that takes it over its size.
            while (k := np.searchsorted(reach[groups_at], reach[low] + UNIT_BYTES - size, side="right")) < len(groups_at):
                yield done([*held, batch.slice(low, groups_at[k] - low)])
                held, size, low = [], 0, groups_at[k]
            held.append(batch.slice(low))
            size += int(reach[-1] - reach[low])
            last = keys[:, -1]
        if held:
            yield done(held)

    chunk = F.pmod(F.xxhash64("doc", "tie", "start"), F.col("parts")).alias("chunk")
    dealt = contexts_of.select("key", "sub", "parts", chunk, "doc", "tie", "start", "body")
    keys = ("key", "sub", "parts", "chunk")
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(sort, _SORTED)


def _sorted_out(contexts_of: DataFrame, length: int, most: int, crowded: bool) -> DataFrame:
    """Runs of repeats among the contexts; crowded anchors go from level to level until one chunk is left."""
    marks = ("doc", "tie", "start", "windows")
    if not crowded:
        return _chunks_sorted(contexts_of, length, most).select(*marks)
    found = None
    while True:
        level = written(_chunks_sorted(contexts_of, length, most), "sorted")
        runs = level.where("windows is not null").select(*marks)
        found = runs if found is None else found.unionByName(runs)
        contexts_of = level.where("windows is null")
        if contexts_of.isEmpty():
            return found


_RESULT = "row long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string"


def _cut_out(rows: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Texts with their runs of repeated windows: what is removed and what is left."""
    span = [pa.field("start", pa.int64()), pa.field("end", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(2)
            of = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).to_numpy())
            start, windows = (column.to_numpy() for column in runs.flatten().flatten())
            of, first, size = merged_runs(of, start, windows + length - 1)
            bounds = np.searchsorted(of, np.arange(len(runs) + 1))
            removed = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])[bounds]
            first_of, end_of = first.tolist(), (first + size).tolist()
            kept = []
            for body, low, high in zip(batch.column(1).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                left = zip([0, *end_of[low:high]], [*first_of[low:high], len(body)], strict=True)
                kept.append(b"".join([body[a:b] for a, b in left]))
            spans = pa.StructArray.from_arrays([pa.array(first), pa.array(first + size)], fields=span)
            arrays = [
                batch.column(0),
                pc.binary_length(batch.column(1)).cast(pa.int64()),
                pa.array(np.diff(removed)),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spans),
                pa.array(kept if with_text else [None] * len(kept), pa.binary()),
                pa.array([hashlib.sha256(body).hexdigest() for body in kept], pa.string()),
            ]
            names = ["row", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.select("row", "body", "runs").mapInArrow(cut, _RESULT)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    most_contexts: int = MOST_CONTEXTS,
    with_text: bool = True,
) -> DataFrame:
    """Per document ``id``, sizes, ``spans`` that are removed, ``kept`` bytes and their digest."""
    rows = numbered(addressed(docs)).select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc"),
        F.col("_number").alias("tie"),
        whole_text(text_col).cast("binary").alias("body"),
    )
    marks = written(_resolved(_anchored(rows, length)), "marks")
    runs = F.collect_list(F.struct("start", "windows", "key")).alias("marks")
    met = rows.join(marks.groupBy("doc", "tie").agg(runs), ["doc", "tie"], "left")
    free = F.col("marks").isNull()
    # Only texts with marks are kept; the others have their result already.
    met = written(
        met.select(
            "id",
            "doc",
            "tie",
            "marks",
            F.when(~free, F.col("body")).alias("body"),
            F.length("body").cast("long").alias("n_bytes"),
            F.when(free, F.sha2("body", 256)).alias("sha"),
            F.when(free & F.lit(with_text), F.col("body")).alias("whole"),
        ),
        "met",
    )
    crowded = marks.where("key is not null").groupBy("key").count().where(F.col("count") > most_contexts)
    crowded = written(crowded.select("key", _crowded_parts(F.col("count"), most_contexts)), "crowded")
    # The bytes are cut before they are dealt into rows, so no row carries the whole text.
    edge = F.expr(
        "explode(transform(filter(marks, m -> m.key is not null), m -> struct(m.key, m.start, "
        f"substring(body, cast(m.start + 1 as int), cast(m.windows + {length - 1} as int)) as body)))"
    )
    edges = met.where("marks is not null").select("doc", "tie", edge.alias("edge")).select(
        "edge.key", "doc", "tie", "edge.start", "edge.body"
    )
    edges = edges.join(crowded, "key", "left").select(
        "key", F.coalesce("parts", F.lit(1)).alias("parts"), "doc", "tie", "start", "body"
    )
    known, any_crowded = [], not crowded.isEmpty()
    for gram in (length - less for less in LESS if length - less > GRAM):
        if any_crowded:
            runs, edges, any_crowded = _finer(edges, length, gram, most_contexts)
            known.append(runs)
    found = _sorted_out(_split(edges, length), length, most_contexts, any_crowded)
    for runs in known:
        found = found.unionByName(runs)
    found = found.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "windows")).alias("more"))
    whole_runs = F.transform(
        F.filter("marks", lambda mark: mark["key"].isNull()),
        lambda mark: F.struct(mark["start"].alias("start"), mark["windows"].alias("windows")),
    )
    none = F.array().cast("array<struct<start:long,windows:long>>")
    marked = met.where("marks is not null").select("id", "doc", "tie", "body", whole_runs.alias("runs"))
    marked = marked.join(found, ["doc", "tie"], "left").select(
        F.col("id").alias("row"), "body", F.concat("runs", F.coalesce("more", none)).alias("runs")
    )
    untouched = met.where("marks is null").select(
        F.col("id").alias("row"),
        "n_bytes",
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.col("whole").alias("kept"),
        F.col("sha").alias("kept_sha256"),
    )
    return _cut_out(marked, length, with_text).unionByName(untouched).withColumnRenamed("row", "id")


def op1_suffix_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, with_text=False).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
