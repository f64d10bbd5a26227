"""Arrow batches of texts as flat byte arrays, for work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value starts (one place more than values)."""
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    starts = np.frombuffer(places, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def groups(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of values of about ``most`` bytes together; a longer value is a run of its own."""
    first = 0
    while first < len(starts) - 1:
        last = int(np.searchsorted(starts, starts[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(starts) - 1)
        yield first, last
        first = last


def lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A list column from its values and the start of each list."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values))


_TABLE = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def runs(data: np.ndarray, starts: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes outside ``gap``, none over two texts: the text number, the length and a hash of each."""
    inside = ~gap
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    first = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], gap[:-1]])))
    last = np.flatnonzero(inside & (edge[1:] | np.concatenate([gap[1:], [True]]))) + 1
    powers = np.cumprod(np.full(len(data), _BASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * powers)])
    back = np.cumprod(np.full(len(data), pow(_BASE, -1, 1 << 64), np.uint64))
    value = (sums[last] - sums[first]) * back[first]
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.searchsorted(starts, first, side="right") - 1, last - first, value


def word_runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words between white space, A-Z lower-cased: text number, length and hash of each."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return runs(_LOWER.astype(np.uint8)[data], starts, _SPACE[data])
