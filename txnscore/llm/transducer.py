"""Minimal acyclic transducers: a sorted list of keys as an automaton that gives each key its place in the list."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Transducer:
    """Edges as ``state << 8 | byte`` with their target and the number of keys that come before those beyond the edge.

    ``final`` tells which states end a key. The ordinal of a key is the sum of ``before`` along its path.
    """

    edges: np.ndarray
    targets: np.ndarray
    before: np.ndarray
    final: np.ndarray
    root: int
    size: int


def build(keys: Iterable[bytes]) -> Transducer:
    """The transducer of strictly ascending keys.

    Keys come in order, so once a key leaves the path of the one before, the states behind the branch are complete.
    Each is then looked up by its ending and edges: a state that is there already is shared, which keeps the automaton
    minimal at all times.
    """
    known: dict[tuple, int] = {}
    counts: list[int] = []
    edges: list[int] = []
    targets: list[int] = []
    before: list[int] = []
    final: list[bool] = []

    def settle(state: list) -> int:
        """The number of a complete state [ends a key, byte, target, byte, target...]."""
        signature = tuple(state)
        number = known.get(signature)
        if number is None:
            number = known[signature] = len(counts)
            passed = int(state[0])
            for byte, target in zip(state[1::2], state[2::2], strict=True):
                edges.append(number << 8 | byte)
                targets.append(target)
                before.append(passed)
                passed += counts[target]
            counts.append(passed)
            final.append(state[0])
        return number

    path: list[list] = [[False]]
    last = b""
    for key in keys:
        shared = 0
        for a, b in zip(last, key, strict=False):
            if a != b:
                break
            shared += 1
        if key <= last and (last or path[0][0]):
            raise ValueError("keys must ascend")
        for _ in range(len(path) - 1 - shared):
            number = settle(path.pop())
            path[-1].append(number)
        for byte in key[shared:]:
            path[-1].append(byte)
            path.append([False])
        path[-1][0] = True
        last = key
    while len(path) > 1:
        number = settle(path.pop())
        path[-1].append(number)
    root = settle(path[0])
    return Transducer(
        np.array(edges, np.int64),
        np.array(targets, np.int32),
        np.array(before, np.int64),
        np.array(final, bool),
        root,
        counts[root],
    )


class Runner:
    """Follows many paths at once, with the edges in a hash table."""

    def __init__(self, automaton: Transducer) -> None:
        self.automaton = automaton
        bits = max(4, int(np.ceil(np.log2(3 * len(automaton.edges) + 1))))
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.edge = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        waiting = np.arange(len(automaton.edges))
        place = self._home(automaton.edges)
        while len(waiting):
            free = self.keys[place] == -1
            self.keys[place[free]] = automaton.edges[waiting[free]]
            self.edge[place[free]] = waiting[free]
            # Of several edges with one place the last has got it.
            lost = self.edge[place] != waiting
            lost |= self.keys[place] != automaton.edges[waiting]
            waiting, place = waiting[lost], (place[lost] + 1) & self.last

    def _home(self, wanted: np.ndarray) -> np.ndarray:
        return ((wanted.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def follow(self, states: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, -1 where there is none, and what the edges add to the ordinals."""
        wanted = states.astype(np.int64) << 8 | chars
        place = self._home(wanted)
        found = self.keys[place]
        hit = found == wanted
        open_ones = np.flatnonzero(~hit & (found != -1))
        while len(open_ones):
            place[open_ones] = (place[open_ones] + 1) & self.last
            found = self.keys[place[open_ones]]
            hit[open_ones] = found == wanted[open_ones]
            open_ones = open_ones[(found != wanted[open_ones]) & (found != -1)]
        if not len(self.automaton.edges):
            return np.full(len(wanted), -1, np.int32), np.zeros(len(wanted), np.int64)
        edge = self.edge[place]
        return np.where(hit, self.automaton.targets[edge], -1), np.where(hit, self.automaton.before[edge], 0)

    def start(self, prefix: bytes) -> tuple[int, int]:
        """State and ordinal behind a beginning of keys, state -1 where no key begins so."""
        state, ordinal = self.automaton.root, 0
        for byte in prefix:
            states, added = self.follow(np.array([state]), np.array([byte]))
            state, ordinal = int(states[0]), ordinal + int(added[0])
            if state < 0:
                break
        return state, ordinal

    def ordinals(
        self, data: np.ndarray, first: np.ndarray, last: np.ndarray, states: np.ndarray, ordinals: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Which of the runs of bytes ``data[first:last]`` end a key from their starting states, and its ordinal."""
        at = np.flatnonzero(states >= 0)
        places, states, ordinals = first[at].copy(), states[at], ordinals[at]
        ended, found = [], []
        while len(at):
            over = places == last[at]
            if over.any():
                done = over & self.automaton.final[states]
                ended.append(at[done])
                found.append(ordinals[done])
                at, places, states, ordinals = (values[~over] for values in (at, places, states, ordinals))
            states, added = self.follow(states, data[places])
            alive = states >= 0
            at, places, states, ordinals = at[alive], places[alive] + 1, states[alive], (ordinals + added)[alive]
        if not ended:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ended), np.concatenate(found)
