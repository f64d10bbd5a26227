"""Noisy-channel restoration of obfuscated words.

A written word is a noisy form of an intended one: letters stand as digits or signs, are repeated, or are kept apart
by signs or spaces. Each written character gives the letters it may stand for, or nothing, with a cost; the best
reading under a trigram model of letters is found by Viterbi search over the last two letters. A state keeps its few best
readings, since a known word is worth more at its end. Runs of any length are read to their end; letters on which all
readings agree are put aside meanwhile, so a long run takes no more memory than a short one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import numpy as np

LETTERS = "abcdefghijklmnopqrstuvwxyz"
EDGE, OTHER, SIZE = 0, 27, 28

#: What a sign or digit may stand for. Fixed values.
STANDS_FOR = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
    "£": "l",
}
APART = set(".-_*~'`,/\\:;")
SWAP, GAP, AGAIN, LOST, KEPT = -1.0, -0.7, -0.5, -6.0, -4.0
#: Readings kept per state of the search.
KEEP = 4
#: So many signs are read before agreed letters are looked for.
STRETCH = 48

_CLEAN_RUN = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+])(?:[ .\-_*](?:[^\W_]|[@$!|+])){2,}(?!\S)")
_SIGN = r"(?:[^\W_]|[@$!|+(€£])"
#: Parts of a token: letters kept apart by signs, or a run without signs that stand for nothing.
_PARTS = re.compile(rf"(?<!{_SIGN}){_SIGN}(?:[.\-_*~'`,/\\:;]+{_SIGN}(?!{_SIGN})){{2,}}|{_SIGN}+")
_STRIP_LEFT = ".,;:?\"'()[]{}<>*&%#~`_-=/\\^"
_STRIP_RIGHT = _STRIP_LEFT + "!"


def _fold_table() -> np.ndarray:
    """Letter numbers of the code points below 0x250; accents are dropped."""
    table = np.zeros(0x250, np.int64)
    for code in range(0x250):
        base = unicodedata.normalize("NFKD", chr(code).lower())[:1]
        if base and base in LETTERS:
            table[code] = 1 + LETTERS.index(base)
        elif chr(code).isalpha():
            table[code] = OTHER
    return table


_TABLE = _fold_table()


def letter_numbers(text: str) -> np.ndarray:
    """1 to 26 for letters, 27 for other letters, 0 for all that is no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "ignore"), np.uint32)
    return np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], OTHER)


def trigram_counts(text: str) -> np.ndarray:
    """How often each triple of letter numbers occurs; runs of non-letters are one edge."""
    numbers = np.concatenate([[EDGE], letter_numbers(text), [EDGE]])
    numbers = numbers[np.concatenate([[True], (numbers[1:] != EDGE) | (numbers[:-1] != EDGE)])]
    if len(numbers) < 3:
        return np.zeros(SIZE**3, np.int64)
    return np.bincount(numbers[:-2] * SIZE * SIZE + numbers[1:-1] * SIZE + numbers[2:], minlength=SIZE**3)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(letter | two letters before), smoothed by the pair and single counts."""
    three = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
    p3 = (three + 5 * p2) / (three.sum(2, keepdims=True) + 5)
    return np.log(p3)


#: A reading is (letters, a hash of them, the reading before the last letter, the last letter).
_Reading = tuple
_NOTHING: _Reading = (0, 0, None, "")


def _longer(reading: _Reading, letter: str) -> _Reading:
    return reading[0] + 1, hash((reading[1], ord(letter))), reading, letter


def _written_out(reading: _Reading) -> str:
    letters = []
    while reading[2] is not None:
        letters.append(reading[3])
        reading = reading[2]
    return "".join(reversed(letters))


def _agreed(readings: list[_Reading], size: int) -> _Reading | None:
    """The first ``size`` letters of all readings if they agree on them."""
    found = None
    for reading in readings:
        while reading[0] > size:
            reading = reading[2]
        if reading[0] < size or (found and reading[1] != found[1]):
            return None
        found = reading
    return found


def _cut(reading: _Reading, size: int) -> _Reading:
    """The reading without its first ``size`` letters."""
    tail = []
    while reading[0] > size:
        tail.append(reading[3])
        reading = reading[2]
    left = _NOTHING
    for letter in reversed(tail):
        left = _longer(left, letter)
    return left


class Restorer:
    """Restores words under a letter model; known words get ``bonus`` on top."""

    def __init__(self, model: np.ndarray, known: Iterable[str] = (), bonus: float = 6.0) -> None:
        self.model = model.tolist()
        self.known = set(known)
        self.bonus = bonus
        self.collapsed = {_DOUBLE.sub(r"\1", word) for word in self.known}

    def _choices(self, char: str) -> list[tuple[str, float]]:
        if char in STANDS_FOR:
            kept = [("", GAP)] if char in APART else [("", LOST)]
            return [(letter, SWAP) for letter in STANDS_FOR[char]] + kept
        if char in APART:
            return [("", GAP)]
        return [(char, 0.0 if char.isalpha() else KEPT)]

    def viterbi(self, word: str) -> str:
        """The likeliest reading of a written word."""
        number = lambda c: int(_TABLE[ord(c)]) or OTHER if ord(c) < len(_TABLE) else OTHER
        model = self.model
        states: dict[tuple[int, int], list[tuple[float, _Reading]]] = {(EDGE, EDGE): [(0.0, _NOTHING)]}
        settled: list[str] = []
        for at, char in enumerate(word, 1):
            choices = self._choices(char)
            after: dict[tuple[int, int], list[tuple[float, _Reading]]] = {}
            for (a, b), readings in states.items():
                for letter, cost in choices:
                    if not letter:
                        after.setdefault((a, b), []).extend((score + cost, text) for score, text in readings)
                        continue
                    c = number(letter)
                    gain = cost + model[a][b][c]
                    after.setdefault((b, c), []).extend((score + gain, _longer(text, letter)) for score, text in readings)
                    if b == c != EDGE:
                        # The same letter again may be a mere repetition.
                        after.setdefault((a, b), []).extend((score + cost + AGAIN, text) for score, text in readings)
            states = {}
            for state, readings in after.items():
                best: dict[tuple[int, int], tuple[float, _Reading]] = {}
                for score, text in readings:
                    if text[:2] not in best or score > best[text[:2]][0]:
                        best[text[:2]] = (score, text)
                states[state] = sorted(best.values(), key=lambda found: -found[0])[:KEEP]
            if at % STRETCH == 0:
                every = [text for readings in states.values() for _, text in readings]
                size = min(text[0] for text in every) - STRETCH
                if size > 0 and (agreed := _agreed(every, size)):
                    settled.append(_written_out(agreed))
                    states = {
                        state: [(score, _cut(text, size)) for score, text in readings] for state, readings in states.items()
                    }
        before = "".join(settled)
        ends = []
        for (a, b), readings in states.items():
            for score, reading in readings:
                text = _written_out(reading)
                known = not before and text in self.known
                ends.append((score + model[a][b][EDGE] + (self.bonus if known else 0.0), text))
        return before + max(ends)[1] if ends else ""

    def word(self, token: str) -> str:
        """The restored form of a token of lower-cased text; clean words stay as they are."""
        core = token.lstrip(_STRIP_LEFT).rstrip(_STRIP_RIGHT)
        if core.endswith("$$"):
            core = core.rstrip("$")
        if core.isalpha():
            if core in self.known or not (
                _CLEAN_RUN.search(core) or (self.collapsed and _DOUBLE.sub(r"\1", core) in self.collapsed)
            ):
                return core
        elif not any(map(str.isalpha, core)):
            return core
        return self.viterbi(core)

    def words(self, token: str) -> list[str]:
        """The restored forms of a token and of its parts between signs."""
        core = token.lstrip(_STRIP_LEFT).rstrip(_STRIP_RIGHT)
        parts = [] if core.isalnum() else _PARTS.findall(core)
        if len(parts) < 2:
            return [self.word(token)]
        return [self.word(token), *map(self.word, parts)]

    def spaced(self, text: str) -> list[str]:
        """Words whose letters are written apart, put together and restored."""
        return [self.viterbi("".join(c for c in found if c not in " .-_*")) for found in _SPACED.findall(text)]
