"""Suffix sorting in two stages, in numpy.

Suffixes smaller than their successor are sorted directly, by their first bytes. All others are induced: buckets of
first bytes are scanned from the smallest on, and each suffix met puts the one before it, if that is larger, at the
end of what its bucket has so far. Ties beyond the given depth are left in any order.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not."""
    steps = np.flatnonzero(text[:-1] != text[1:])
    rises = np.append(text[steps] < text[steps + 1], False)
    return np.repeat(rises, np.diff(steps, prepend=-1, append=len(text) - 1))


def heads(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` bytes from each place, zero after the end; one row per place."""
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, depth)[places]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of all suffixes in the order of their first ``depth`` bytes at least."""
    size = len(text)
    if not size:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    direct = np.flatnonzero(small)
    keys = np.ascontiguousarray(heads(text, direct, depth)).view(f"S{depth}").ravel()
    direct = direct[np.argsort(keys, kind="stable")]
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([size - 1]))
    order = []
    for byte in range(256):
        bucket = []
        level = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(level):
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[(text[before] == byte) & ~small[before]]
        bucket.append(direct[bounds[byte] : bounds[byte + 1]])
        found = np.concatenate(bucket)
        if not len(found):
            continue
        order.append(found)
        before = found[found > 0] - 1
        before = before[(text[before] > byte) & ~small[before]]
        before = before[np.argsort(text[before], kind="stable")]
        firsts, starts = np.unique(text[before], return_index=True)
        for target, part in zip(firsts, np.split(before, starts[1:]), strict=True) if len(firsts) else ():
            waiting[target].append(part)
    return np.concatenate(order)


def common_prefixes(text: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """How many first bytes each place shares with the place before it in the list, ``most`` at most; first 0."""
    rows = heads(text, places, most)
    same = np.zeros(len(places), np.int64)
    if len(places) > 1:
        differ = rows[1:] != rows[:-1]
        same[1:] = np.where(differ.any(1), differ.argmax(1), most)
    return same
