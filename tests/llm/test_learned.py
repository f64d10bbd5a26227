"""Language identification, toxicity, quality and piece segmentation."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnscore.llm import deobfuscation, languages, pieces, quality, recurrent, toxicity


def _fold(number, folds):
    return zlib.crc32(str(number).encode()) % folds


def test_gradients_of_the_network():
    shape = recurrent.Shape(units=3)
    rng = np.random.default_rng(1)
    weights = {name: value.astype(np.float64) for name, value in recurrent.start_weights(3, shape).items()}
    bodies, label = rng.integers(97, 103, (5, 7)).astype(np.uint8), rng.integers(0, 3, 5)
    grads, _ = recurrent._gradients(weights, bodies, label)
    for name in ("V", "v", "fUz", "bUr", "fUc", "bEc", "fEz"):
        place = np.unravel_index(int(np.abs(grads[name]).argmax()), grads[name].shape)
        losses = []
        for step in (1e-3, -1e-3):
            moved = {key: value.copy() for key, value in weights.items()}
            moved[name][place] += step
            losses.append(recurrent._gradients(moved, bodies, label)[1])
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(grads[name][place], rel=0.02, abs=1e-5)


def test_pieces_cover_every_byte_once():
    sizes = [0, 1, 5, 8, 9, 16, 23]
    data = np.arange(sum(sizes), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    seen = np.zeros(len(data))
    for bodies, weight, _ in languages._cut(data, starts, 8):
        np.add.at(seen, bodies[weight > 0], weight[weight > 0])
    assert (seen == 1).all()


def test_languages_of_documents(spark, documents):
    rows = languages.op3_language_id(spark, documents).collect()
    truth = {row["doc_id"]: row["lang"] for row in documents.collect()}
    assert len(rows) == len(truth) and all(0 <= row["score"] <= 1 for row in rows)
    assert all(row["held_out"] == (_fold(row["doc_id"], 4) == 2) for row in rows)
    held = [row for row in rows if row["held_out"]]
    assert sum(row["lang_pred"] == truth[row["doc_id"]] for row in held) >= 0.95 * len(held)


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    small = recurrent.Shape(steps=5)
    model = languages.train_language_model(odd_docs, shape=small)
    rows = languages.identify(odd_docs, model, ["doc_id"]).collect()
    unknown = {row["doc_id"] for row in rows if row["lang_pred"] == languages.UNKNOWN}
    assert len(rows) == 12 and unknown == {1, 2, 3, 11}
    kept = languages.with_known_language(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 8
    nothing = languages.train_language_model(no_docs)
    assert nothing.languages == ()
    assert {row["lang_pred"] for row in languages.identify(odd_docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert languages.with_known_language(no_docs).count() == 0


def test_gradients_of_padded_pieces():
    shape = recurrent.Shape(units=3)
    rng = np.random.default_rng(1)
    weights = {name: value.astype(np.float64) for name, value in recurrent.start_weights(3, shape).items()}
    bodies, label = rng.integers(97, 103, (5, 7)).astype(np.uint8), rng.integers(0, 3, 5)
    sizes = np.array([7, 3, 1, 5, 7])
    grads, _ = recurrent._gradients(weights, bodies, label, sizes)
    for name in ("V", "v", "fUz", "bUr", "fUc", "bEc", "fEz"):
        place = np.unravel_index(int(np.abs(grads[name]).argmax()), grads[name].shape)
        losses = []
        for step in (1e-3, -1e-3):
            moved = {key: value.copy() for key, value in weights.items()}
            moved[name][place] += step
            losses.append(recurrent._gradients(moved, bodies, label, sizes)[1])
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(grads[name][place], rel=0.02, abs=1e-5)


def test_languages_of_short_texts(spark):
    """One language has short texts only, and many rows without letters that must not fill its sample."""
    rng = np.random.default_rng(4)
    words = {"aa": ["the", "house", "with", "garden"], "bb": ["und", "kein", "zwölf", "jäger"]}
    rows = [(k, " ".join(rng.choice(words["aa"], 40)), "aa") for k in range(200)]
    rows += [(k, " ".join(rng.choice(words["bb"], 5)), "bb") for k in range(200, 400)]
    rows += [(k, "12 34 " * 40, "bb") for k in range(400, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {row["doc_id"]: row["lang_pred"] for row in languages.op3_language_id(spark, docs).collect()}
    assert sum(found[number] == lang for number, _, lang in rows[:400]) >= 380
    short = docs.where("doc_id between 200 and 399")
    assert {row["lang_pred"] for row in languages.op3_language_id(spark, short).collect()} == {"bb"}


def test_filter_without_a_model_keeps_texts_with_letters(spark):
    rows = [(1, "some text", None), (2, "öäü", None), (3, "12 !", None), (4, None, None), (None, "more", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = languages.with_known_language(docs).collect()
    assert sorted(row["text"] for row in kept) == ["more", "some text", "öäü"]


@pytest.fixture(scope="module")
def restorer():
    texts = ["you are an idiot", "stupid and worthless", "the loser said trash", "hello there worthless idiot"] * 5
    counts = sum(deobfuscation.trigram_counts(text) for text in texts)
    words = ["idiot", "stupid", "worthless", "loser", "trash"]
    return deobfuscation.Restorer(deobfuscation.log_probabilities(counts), words)


@pytest.mark.parametrize(
    "written, word",
    [
        ("1d10t", "idiot"),
        ("5tup1d", "stupid"),
        ("$tup1d!", "stupid"),
        ("i.d.i.o.t", "idiot"),
        ("stuuupid", "stupid"),
        ("idioot", "idiot"),
        ("w0rthl3ss,", "worthless"),
        ("tr@sh", "trash"),
        ("there", "there"),
        ("ärger.", "ärger"),
        ("", ""),
        ("...", ""),
        ("2024", "2024"),
    ],
)
def test_restored_words(restorer, written, word):
    assert restorer.word(written) == word


def test_long_runs_are_read_to_their_end(restorer):
    letters = "hello there " * 30 + "1d10t"
    (found,) = restorer.spaced(" ".join(letters.replace(" ", "")))
    assert found.startswith("hel") and found.endswith("idiot") and len(found) > 250
    assert restorer.viterbi("hello" * 20_000 + "1d10t").endswith("idiot")


@pytest.mark.parametrize("joint", [",", "/", "-", "，", "?"])
@pytest.mark.parametrize("times", [1, 30])
def test_words_without_white_space(restorer, joint, times):
    token = joint.join(["hello", "there"] * times + ["5tup1d", "worthless", "1.d.1.0.t", "said"])
    found = restorer.words(token)
    assert {"stupid", "worthless", "said"} <= set(found)
    assert restorer.words("idioot.") == ["idiot"] and restorer.words("i.d.i.o.t") == ["idiot"]


def test_letters_kept_apart_in_a_long_token(restorer):
    assert "idiot" in restorer.words("hello/there/" * 8 + "i.d.1.o.t/said")


def test_toxic_words_without_white_space(restorer):
    reader = toxicity.Reader(np.array(restorer.model), ["stupid$"])
    assert reader.found("hello,there," * 20 + "5tup1d,said") == [0] and reader.found("hello/stupid") == [0]
    assert reader.found(" ".join("hellothere" * 20 + "stupid")) == [0]


def test_learned_beginnings_in_letters_written_apart(restorer):
    reader = toxicity.Reader(np.array(restorer.model), ["idiot", "los", "trash$"])
    assert reader.found("such i d i o t e n here") == [0] and reader.found("you a r e i d i o t e n") == [0]
    assert reader.found("the l o s e r s") == [1] and reader.found("t r a s h") == [2]
    assert reader.found("h e l l o there") == []


def test_spaced_words(restorer):
    assert restorer.spaced("you s t u p i d one") == ["stupid"]
    assert restorer.spaced("a b") == []


def test_toxicity_of_documents(spark, documents, labels):
    rows = {row["doc_id"]: row for row in toxicity.op6_toxicity(spark, documents, labels).collect()}
    assert len(rows) == documents.count()
    assert all(row["held_out"] == (_fold(number, 3) == 1) for number, row in rows.items())
    assert all(row["predicted"] == int(row["score"] >= 0.7) and 0 <= row["score"] <= 1 for row in rows.values())
    clean = [row["doc_id"] for row in labels.where("toxic = 0").collect()]
    assert sum(rows[number]["predicted"] for number in clean if number in rows) <= 0.05 * len(clean)


def test_toxicity_learns_words(spark):
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("abcdefghilmnoprstu"), 5)) for _ in range(400)]
    texts, marks = [], []
    for k in range(240):
        words = list(rng.choice(plain, 30))
        if k % 4 == 0:
            words.insert(7, "nitwit")
        texts.append((k, " ".join(words)))
        marks.append((k, 1, int(k % 4 == 0)))
    obfuscated = [(1000, "oh n1tw1t"), (1001, "oh n i t w i t"), (1002, "oh nittwit dear"), (1003, "plain"), (1004, None)]
    docs = spark.createDataFrame(texts + obfuscated, "doc_id long, text string")
    marked = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = {row["doc_id"]: row["predicted"] for row in toxicity.op6_toxicity(spark, docs, marked).collect()}
    assert [rows[k] for k in range(1000, 1005)] == [1, 1, 1, 0, 0]
    assert all(rows[k] == int(k % 4 == 0) for k in range(240))


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs, labelled):
    rows = toxicity.op6_toxicity(spark, odd_docs, labelled).collect()
    assert len(rows) == 12 and all(0 <= row["score"] <= 1 for row in rows)
    assert len(toxicity.op6_toxicity(spark, odd_docs, labelled.limit(0)).collect()) == 12
    assert toxicity.op6_toxicity(spark, no_docs, labelled).count() == 0


def test_statistics():
    texts = [b"", b"Ab ab\nAb ab", b"A A A !!", b"x"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
    rows = {name: column for name, column in zip(quality.STATISTICS, quality.statistics(data, starts).T, strict=True)}
    assert np.allclose(np.expm1(rows["words"]), [0, 4, 4, 1])
    assert np.allclose(rows["distinct"], [0, 0.5, 0.5, 1]) and np.allclose(rows["repeats"], [0, 0, 0.5, 0])
    assert np.allclose(rows["distinct_lines"], [0, 0.5, 1, 1])


def test_isotonic():
    score, label = np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0, 1, 0, 1, 1])
    at, fitted = quality.isotonic(score, label)
    assert (np.diff(fitted) >= 0).all() and list(at) == sorted(at) and (0 < fitted).all() and (fitted < 1).all()


def test_quality_of_documents(spark, documents, labels):
    rows = {row["doc_id"]: row for row in quality.op8_quality(spark, documents, labels).collect()}
    assert len(rows) == documents.count()
    assert all(row["held_out"] == (_fold(number, 5) == 0) for number, row in rows.items())
    truth = {row["doc_id"]: row["quality"] for row in labels.collect()}
    known = [(rows[number]["predicted"], truth[number]) for number in truth if number in rows]
    # The table has 87 labels; larger ones give 0.99.
    assert sum(a == b for a, b in known) >= 0.85 * len(known)


def test_quality_of_odd_rows(spark, odd_docs, no_docs, labelled):
    for marks in (labelled, labelled.where("quality = 1"), labelled.limit(0)):
        rows = quality.op8_quality(spark, odd_docs, marks).collect()
        assert len(rows) == 12 and all(0 <= row["score"] <= 1 for row in rows)
    assert quality.op8_quality(spark, no_docs, labelled).count() == 0


@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice(pieces.load_vocabulary())


def test_forward_sums_are_those_of_all_paths(lattice):
    word = "▁hater"
    start, end, piece, first = lattice.edges([word])
    edges = {}
    for a, b, p in zip(start, end, piece, strict=True):
        edges.setdefault(int(b), []).append((int(a), int(p)))

    def paths(node):
        if node == 0:
            return [((), 0.0)]
        return [((*path, p), w + lattice.weights[p]) for a, p in edges.get(node, []) for path, w in paths(a)]

    every = paths(len(word))
    weight = np.exp([w for _, w in every])
    share = dict(zip([path for path, _ in every], weight / weight.sum(), strict=True))
    places = 20_000
    found, counts = lattice.sample([word], np.zeros(places, np.int64), np.arange(places, dtype=np.uint64) * np.uint64(977))
    ends = np.cumsum(counts)
    drawn = {}
    for low, high in zip(ends - counts, ends, strict=True):
        drawn[tuple(found[low:high])] = drawn.get(tuple(found[low:high]), 0) + 1
    assert set(drawn) <= set(share)
    for path, expected in share.items():
        assert drawn.get(path, 0) / places == pytest.approx(expected, abs=0.02)


def test_pieces_are_lossless_and_reproducible(spark, odd_docs, no_docs):
    encoded = pieces.encode(odd_docs, F.col("doc_id"))
    assert encoded.columns[: len(odd_docs.columns)] == odd_docs.columns
    rows = pieces.decode(encoded).collect()
    assert len(rows) == 12 and all(row["lossless"] and row["decoded"] == (row["text"] or "") for row in rows)
    assert all(row["n_pieces"] == len(row["piece_ids"]) for row in rows)
    again = pieces.encode(odd_docs.repartition(3, "text"), F.col("doc_id")).collect()
    key = lambda row: (str(row["doc_id"]), str(row["piece_ids"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    other = pieces.encode(odd_docs, F.col("doc_id") + 1).where("doc_id = 7").first()
    assert other["piece_ids"] != next(row["piece_ids"] for row in rows if row["doc_id"] == 7)
    assert pieces.encode(no_docs, F.col("doc_id")).count() == 0


def test_long_texts_and_long_words_in_blocks(spark, monkeypatch):
    """Cut into blocks, a text gets the pieces it gets in one; a word walked by characters samples the same paths."""
    lattice, decoder = pieces.Lattice(pieces.load_vocabulary()), pieces.Decoder(pieces.load_vocabulary())
    text = "  Some words,  and  more\n words ▁ ÄÖ 日本 😀 x" * 60 + "   "
    key = np.array([7], np.uint64)
    whole, _ = pieces.encode_block(lattice, [text], key)
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 100)
    cut, same = pieces.encode_long(lattice, decoder, text, key[0])
    assert same and (cut == whole).all()
    monkeypatch.setattr(pieces, "LONG_WORD", 4)
    walked, counts = pieces.encode_words(lattice, ["▁unbelievable", "▁a", "▁unbelievable"] * 2000, pieces._seeds(np.arange(6000), np.arange(6000)))
    monkeypatch.setattr(pieces, "LONG_WORD", 4096)
    sampled, others = pieces.encode_words(lattice, ["▁unbelievable", "▁a", "▁unbelievable"] * 2000, pieces._seeds(np.arange(6000), np.arange(6000)))
    assert (np.repeat(counts == others, counts).mean()) > 0.999 and (walked == sampled).mean() > 0.999


def test_endless_word(spark):
    picked = random.Random(2)
    texts = ["".join(picked.choices("abcdefgh", k=200_000)), "y" * 100_000 + " and more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pieces.decode(pieces.encode(docs, F.col("doc_id"))).collect()
    assert all(row["lossless"] and row["decoded"] == row["text"] for row in rows)


def test_encode_with_clashing_names(spark):
    names = ["_body", "_seed", "seed", "ids", "_ids", "n_pieces", "LOSSLESS", "piece_ids"]
    docs = spark.createDataFrame([(1, None, *range(8)), (2, "some text", *range(8))], "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    rows = pieces.decode(pieces.encode(docs, F.col("doc_id"))).collect()
    assert [(row["_body"], row["_seed"], row["seed"], row["_ids"]) for row in rows] == [(0, 1, 2, 4)] * 2
    assert [row["decoded"] for row in sorted(rows, key=lambda row: row["doc_id"])] == ["", "some text"]
