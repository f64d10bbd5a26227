"""Sampled SentencePiece segmentations: forward filtering, backward sampling over the piece lattice.

Pieces come from a public model file and are never trained here; a piece's weight follows its rank. A text is a
lattice of pieces over its characters. No piece goes over a word start, so the lattice falls apart into words, and
the forward sums of a word are computed once for all its places. Each place then draws its own path backwards, with
random numbers hashed from the row's key and the place, so that reruns and other partitionings give the same pieces.
Characters that no piece has, and the word sign itself, are written as byte pieces, so decoding is lossless.

Texts are worked on in blocks of some 512 KB, long texts in as many blocks as they need, cut between words, so memory does
not grow with the length of a text. A word of very many characters is a lattice that is walked character by character.

Defined results: a null text is empty and has no pieces. Rows with the same key and text get the same pieces. An
empty table gives no rows. Other columns are carried along, whatever their names; a column of the input that has the
name of an added one is replaced by it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscore.llm.batches import flat, groups, lists
from txnscore.llm.common import free_names

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Bytes without a piece of their character stand in the lattice as these private code points.
BYTE_BASE = 0xF0000
#: Texts worked on together; words from so many characters on are walked one character at a time.
BLOCK_BYTES = 512 << 10
LONG_WORD = 4096
_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their weights, and the first id of the 256 byte pieces."""

    pieces: tuple[str, ...] = field(repr=False)
    weights: np.ndarray = field(repr=False)
    first_byte: int
    special: int


def load_vocabulary(path: str | None = None, sharpness: float = 1.0) -> Vocabulary:
    """The pieces of a model file; the weight is the log of a power law over ranks, times ``sharpness``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or model_path())
    size = model.get_piece_size()
    pieces = tuple(model.id_to_piece(k) for k in range(size))
    first_byte = next(k for k in range(size) if model.is_byte(k))
    special = first_byte + 256
    rank = np.array([-model.get_score(k) for k in range(size)])
    rank[:special] = size
    odds = 1 / (rank + 10)
    return Vocabulary(pieces, np.log(odds / odds.sum()) * sharpness, first_byte, special)


def _draws(seeds: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Numbers from 0 up to 1 for the given steps of the paths that the seeds stand for."""
    draw = seeds + (np.atleast_1d(step).astype(np.uint64) + np.uint64(1)) * _STEP
    draw ^= draw >> np.uint64(30)
    draw *= _MIX
    draw ^= draw >> np.uint64(27)
    draw *= np.uint64(0x94D049BB133111EB)
    return (draw >> np.uint64(11)).astype(float) * 2.0**-53


class Lattice:
    """The trie of the pieces as a hash table of (state, character), with lookups over whole arrays."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.weights, self.first_byte = vocabulary.weights, vocabulary.first_byte
        moves: dict[tuple[int, int], int] = {}
        ends = {0: -1}
        known = set()
        self.longest = 1
        self.numbers: dict[str, int] = {}
        for number, piece in enumerate(vocabulary.pieces):
            if number < vocabulary.special:
                continue
            state = 0
            for char in piece:
                state = moves.setdefault((state, ord(char)), len(moves) + 1)
            ends[state] = self.numbers[piece] = number
            self.longest = max(self.longest, len(piece))
            if len(piece) == 1:
                known.add(piece)
        self.piece_of = np.full(len(moves) + 1, -1, np.int32)
        for state, number in ends.items():
            self.piece_of[state] = number
        self.bits = max(10, int(np.ceil(np.log2(3 * len(moves)))))
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        self.probes = 1
        for (state, char), target in moves.items():
            key = state << 21 | char
            place, tries = int(self._home(np.array([key]))[0]), 1
            while self.keys[place] != -1:
                place, tries = (place + 1) & ((1 << self.bits) - 1), tries + 1
            self.keys[place], self.values[place] = key, target
            self.probes = max(self.probes, tries)
        known.discard(SPACE)
        escaped = "".join(re.escape(char) for char in sorted(known))
        self.unknown = re.compile(f"[^ {escaped}]+")
        low, high = chr(BYTE_BASE), chr(BYTE_BASE + 255)
        self.words = re.compile(f"[{low}-{high}]|{SPACE}*[^{SPACE}{low}-{high}]+|{SPACE}+")

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def follow(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The next states, -1 where the trie has none."""
        wanted = states.astype(np.int64) << 21 | chars
        place = self._home(wanted)
        result = np.full(len(wanted), -1, np.int32)
        found = self.keys[place]
        hit = found == wanted
        result[hit] = self.values[place[hit]]
        open_ones = np.flatnonzero(~hit & (found != -1))
        for _ in range(1, self.probes):
            if not len(open_ones):
                break
            place[open_ones] = (place[open_ones] + 1) & (len(self.keys) - 1)
            found = self.keys[place[open_ones]]
            hit = found == wanted[open_ones]
            result[open_ones[hit]] = self.values[place[open_ones[hit]]]
            open_ones = open_ones[~hit & (found != -1)]
        return result

    def split(self, text: str, inside: bool = False) -> list[str]:
        """The words of a text, spaces as word signs, unknown characters as single bytes.

        A word sign goes before a text, but not before a part from inside of it.
        """
        if not text:
            return []
        text = self.unknown.sub(lambda found: "".join(chr(BYTE_BASE + b) for b in found[0].encode()), text)
        return self.words.findall(("" if inside else SPACE) + text.replace(" ", SPACE))

    def edges(self, words: Sequence[str]) -> tuple[np.ndarray, ...]:
        """All pieces in all words: start node, end node and piece, by end node; and the first node of each word.

        Nodes are numbered through all words, one more per word than it has characters.
        """
        sizes = np.array([len(word) for word in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
        first = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int32)
        owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        node = np.arange(len(chars), dtype=np.int32) + owner
        stop = np.cumsum(sizes).astype(np.int32)[owner]
        found = []
        lone = chars >= BYTE_BASE
        found.append((node[lone], node[lone] + 1, (chars[lone] - BYTE_BASE + self.first_byte).astype(np.int32)))
        at = np.flatnonzero(~lone).astype(np.int32)
        states = np.zeros(len(at), np.int32)
        for size in range(1, self.longest + 1):
            inside = at + size - 1 < stop[at]
            at, states = at[inside], states[inside]
            states = self.follow(states, chars[at + size - 1])
            there = states >= 0
            at, states = at[there], states[there]
            if not len(at):
                break
            piece = self.piece_of[states]
            ends = piece >= 0
            found.append((node[at[ends]], node[at[ends]] + size, piece[ends]))
        start, end, piece = (np.concatenate(parts) for parts in zip(*found, strict=True))
        order = np.argsort(end, kind="stable")
        return start[order], end[order], piece[order], first

    def forward(self, words: Sequence[str]) -> tuple[np.ndarray, ...]:
        """Edges by end node with the cumulative share of each among those of its end node."""
        start, end, piece, first = self.edges(words)
        local = end - first[np.searchsorted(first, end, side="right") - 1]
        alpha = np.zeros(first[-1])
        mass = np.empty(len(start))
        # No word here has more characters than two bytes count.
        local = local.astype(np.uint16)
        order = np.argsort(local, kind="stable")
        bounds = np.searchsorted(local[order], np.arange(1, (local.max() if len(local) else 0) + 2))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            rows = order[low:high]
            value = alpha[start[rows]] + self.weights[piece[rows]]
            to = end[rows]
            heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, heads)
            counts = np.diff(np.append(heads, len(rows)))
            value = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(value, heads)
            alpha[to[heads]] = top + np.log(total)
            mass[rows] = value / np.repeat(total, counts)
        # Running shares within an end node, shifted by the node, make one sorted array to search in.
        running = np.cumsum(mass)
        heads = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]])) if len(end) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(end)))
        before = np.repeat(running[heads] - mass[heads], counts) if len(end) else running
        shares = np.clip(running - before, 0, 1)
        if len(end):
            shares[np.append(heads[1:], len(end)) - 1] = 1.0
        return start, end + shares, piece, first

    def sample(self, words: Sequence[str], word_of: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of every place and their number, a path drawn backwards for each place by its seed."""
        start, shares, piece, first = self.forward(words)
        heads = np.searchsorted(shares, np.arange(first[-1]), side="right")
        begin, now = first[word_of], first[word_of + 1] - 1
        active, counts, steps = np.arange(len(word_of)), np.zeros(len(word_of), np.int64), []
        while len(active):
            share = _draws(seeds[active], len(steps))
            # The first edge of the node whose share is above the draw; a node has few edges.
            edge, wanted = heads[now], np.minimum(now + share, np.nextafter(now + 1.0, 0))
            low = np.flatnonzero(shares[edge] <= wanted)
            while len(low):
                edge[low] += 1
                low = low[shares[edge[low]] <= wanted[low]]
            steps.append((active.astype(np.int32), piece[edge]))
            counts[active] += 1
            now = start[edge]
            more = now > begin[active]
            active, now = active[more], now[more]
        ends = np.cumsum(counts)
        pieces = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for nth, (places, found) in enumerate(steps):
            pieces[ends[places] - 1 - nth] = found
        return pieces, counts


    def walk(self, word: str, seeds: np.ndarray) -> list[np.ndarray]:
        """The same for one word of any length, once per seed; only the sums of its nodes are kept."""

        def incoming(end: int) -> list[tuple[int, int]]:
            """Pieces that end there, shortest first, with the node each starts from."""
            starts = range(end - 1, max(0, end - self.longest) - 1, -1)
            return [(k, self.numbers[word[k:end]]) for k in starts if word[k:end] in self.numbers]

        weights = self.weights.tolist()
        alpha = np.zeros(len(word) + 1)
        for end in range(1, len(word) + 1):
            values = [alpha[start] + weights[piece] for start, piece in incoming(end)]
            top = max(values)
            alpha[end] = top + math.log(sum(math.exp(value - top) for value in values))
        paths = []
        for seed in seeds:
            now, pieces = len(word), []
            while now:
                if len(pieces) % LONG_WORD == 0:
                    draws = _draws(np.full(LONG_WORD, seed), len(pieces) + np.arange(LONG_WORD))
                left, edges = float(draws[len(pieces) % LONG_WORD]), incoming(now)
                for start, piece in edges:
                    left -= math.exp(alpha[start] + weights[piece] - alpha[now])
                    if left < 0:
                        break
                pieces.append(piece)
                now = start
            paths.append(np.array(pieces[::-1], np.int32))
        return paths


def _decoded(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes each piece stands for."""
    texts = [piece.replace(SPACE, " ").encode() for piece in vocabulary.pieces]
    texts[: vocabulary.special] = [b""] * vocabulary.special
    for byte in range(256):
        texts[vocabulary.first_byte + byte] = bytes([byte])
    return texts


class Decoder:
    """Puts pieces together again."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        texts = _decoded(vocabulary)
        self.sizes = np.array([len(text) for text in texts])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, pieces: np.ndarray, starts: np.ndarray, inside: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and starts of the texts of lists of pieces; the space put before a text is taken off.

        Lists from inside of a text have none.
        """
        sizes = self.sizes[pieces]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.first[pieces] - (ends - sizes), sizes)
        places = np.concatenate([[0], ends])[starts]
        if inside:
            return self.data[at], places
        keep = np.ones(total, bool)
        keep[places[:-1][starts[1:] > starts[:-1]]] = False
        lost = np.concatenate([[0], np.cumsum(starts[1:] > starts[:-1])])
        return self.data[at][keep], places - lost


def encode_words(lattice: Lattice, words: Sequence[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all words, one after the other, and how many each has."""
    known = sorted(set(words), key=len)
    usual = bisect_left(known, LONG_WORD, key=len)
    numbers = dict(zip(known, range(len(known)), strict=True))
    word_of = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    short = word_of < usual
    if usual:
        pieces, counts = lattice.sample(known[:usual], word_of[short], seeds[short])
    else:
        pieces, counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
    if len(counts) == len(words):
        return pieces, counts
    paths: dict[int, np.ndarray] = {}
    for number in range(usual, len(known)):
        places = np.flatnonzero(word_of == number)
        paths.update(zip(places.tolist(), lattice.walk(known[number], seeds[places]), strict=True))
    all_counts = np.zeros(len(words), np.int64)
    all_counts[short] = counts
    for k, path in paths.items():
        all_counts[k] = len(path)
    ends = np.cumsum(all_counts)
    result = np.empty(int(ends[-1]), np.int32)
    result[np.repeat(short, all_counts)] = pieces
    for k, path in paths.items():
        result[ends[k] - len(path) : ends[k]] = path
    return result, all_counts


def _seeds(keys: np.ndarray, nth: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64) * _MIX + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def encode_block(lattice: Lattice, texts: Sequence[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts and where the list of each text starts; ``keys`` seed the draws."""
    words: list[str] = []
    firsts = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        words += lattice.split(text)
        firsts[k + 1] = len(words)
    sizes = np.diff(firsts)
    nth = np.arange(len(words)) - np.repeat(firsts[:-1], sizes)
    pieces, counts = encode_words(lattice, words, _seeds(np.repeat(keys.astype(np.uint64), sizes), nth))
    return pieces, np.concatenate([[0], np.cumsum(counts)])[firsts]


#: Where a text may be cut: before the first of some spaces.
_BREAK = re.compile("[^ ] ")


def encode_long(lattice: Lattice, decoder: Decoder, text: str, key: np.ndarray) -> tuple[np.ndarray, bool]:
    """Pieces of one text, a block at a time, and whether decoding gives the text."""
    found, at, nth, same = [], 0, 0, True
    while at < len(text):
        stop = _BREAK.search(text, at + BLOCK_BYTES)
        end = stop.start() + 1 if stop else len(text)
        words = lattice.split(text[at:end], inside=at > 0)
        pieces, _ = encode_words(lattice, words, _seeds(np.full(len(words), key), nth + np.arange(len(words))))
        back, _ = decoder.decode(pieces, np.array([0, len(pieces)]), inside=at > 0)
        same = same and back.tobytes() == text[at:end].encode("utf-8", "surrogateescape")
        found.append(pieces)
        at, nth = end, nth + len(words)
    return np.concatenate(found) if found else np.zeros(0, np.int32), same


def encode(
    docs: DataFrame, key: Column, text_col: str = "text", vocabulary: Vocabulary | None = None, check: bool = True
) -> DataFrame:
    """The rows with ``piece_ids``, ``n_pieces`` and, if checked, ``lossless``: whether decoding gives the text."""
    vocabulary = vocabulary or load_vocabulary()
    added = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())]
    if check:
        added.append(T.StructField("lossless", T.BooleanType()))
    replaced = {field.name for field in added}
    kept = [field for field in docs.schema.fields if field.name.lower() not in replaced]
    if text_col not in [field.name for field in kept]:
        raise ValueError(f"{text_col} is not a column of the input that is kept")
    schema = T.StructType([*kept, *added])
    at = [field.name for field in kept].index(text_col)
    share = docs.sparkSession.sparkContext.broadcast(vocabulary)  # 32,000 pieces, a fixed size

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, decoder = Lattice(share.value), Decoder(share.value)
        for batch in batches:
            column = batch.column(at)
            if column.null_count:
                column = column.fill_null("")
            keys = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64)
            data, starts = flat(column)
            for first, last in groups(starts, BLOCK_BYTES):
                own = starts[first : last + 1]
                texts = [data[a:b].tobytes().decode("utf-8", "surrogateescape") for a, b in zip(own, own[1:], strict=False)]
                if last - first == 1 and own[1] - own[0] > BLOCK_BYTES:
                    ids, sound = encode_long(lattice, decoder, texts[0], keys[first])
                    places, same = np.array([0, len(ids)]), np.array([sound])
                else:
                    ids, places = encode_block(lattice, texts, keys[first:last])
                    same = _lossless(decoder, ids, places, data, own) if check else None
                columns = [*[c[first:last] for c in batch.columns[:-1]], lists(ids, places), pa.array(np.diff(places))]
                if check:
                    columns.append(pa.array(same))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    seed = free_names(schema.names, "seed")["seed"]
    return docs.select(*[F.col(f"`{field.name}`") for field in kept], F.xxhash64(key).alias(seed)).mapInArrow(segment, schema)


def _lossless(
    decoder: Decoder, ids: np.ndarray, places: np.ndarray, data: np.ndarray, own: np.ndarray
) -> np.ndarray:
    """Which of the texts ``data[own[k]:own[k + 1]]`` their pieces give again."""
    back, at = decoder.decode(ids, places)
    same = np.diff(at) == np.diff(own)
    if same.all():
        wrong = np.flatnonzero(back != data[own[0] : own[-1]])
        same[np.searchsorted(at, wrong, side="right") - 1] = False
        return same
    texts = zip(at[:-1], at[1:], own[:-1], own[1:], strict=True)
    return same & [bytes(back[a:b]) == bytes(data[c:d]) for a, b, c, d in texts]


def decode(rows: DataFrame, ids_col: str = "piece_ids", vocabulary: Vocabulary | None = None) -> DataFrame:
    """The rows with ``decoded``, the text of their pieces; null pieces are the empty text."""
    vocabulary = vocabulary or load_vocabulary()
    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    share = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(share.value)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            starts = np.asarray(ids.offsets).astype(np.int64)
            pieces = ids.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]]
            data, places = decoder.decode(pieces, starts - starts[0])
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(places, places[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return rows.select("*", ids.alias(free_names(rows.columns, "ids")["ids"])).mapInArrow(join, schema)


def op5_sentencepiece(spark: SparkSession, docs: DataFrame) -> DataFrame:
    encoded = encode(docs.select("doc_id", "text"), F.col("doc_id"))
    return encoded.select("doc_id", "n_pieces", "lossless", "piece_ids")
