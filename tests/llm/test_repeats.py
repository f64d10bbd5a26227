"""Suffix arrays, repeat removal, near duplicates and the pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from txnscore.llm import near_dedup, repeats, suffixes


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=80) | st.text("ab", min_size=1, max_size=60).map(str.encode))
def test_suffix_order(text):
    order = suffixes.suffix_order(np.frombuffer(text, np.uint8), 120)
    padded = [text[k:].ljust(120, b"\0") for k in order]
    assert sorted(order) == list(range(len(text))) and padded == sorted(padded)


def test_common_prefixes():
    text = np.frombuffer(b"abcabd", np.uint8)
    assert list(suffixes.common_prefixes(text, np.array([0, 3, 1, 4]), 4)) == [0, 2, 0, 1]


def _brute_repeats(rows, length):
    """What each row (id, text), in order, loses."""
    seen, out = set(), []
    for number, text in rows:
        body = (text or "").encode()
        covered = np.zeros(len(body), bool)
        for at in range(len(body) - length + 1):
            window = body[at : at + length]
            if window in seen:
                covered[at : at + length] = True
            seen.add(window)
        kept = np.frombuffer(body, np.uint8)[~covered].tobytes()
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((number, len(body), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _found_repeats(docs, **kinds):
    rows = repeats.remove_repeats(docs, **kinds).collect()
    assert all(hashlib.sha256(bytes(row["kept"])).hexdigest() == row["kept_sha256"] for row in rows)
    return sorted((row["id"], row["n_bytes"], row["n_removed"], len(row["spans"]), row["kept_sha256"]) for row in rows)


def test_repeats_of_documents(documents):
    rows = sorted((row["doc_id"], row["text"]) for row in documents.collect())
    assert _found_repeats(documents) == _brute_repeats(rows, 100)


@pytest.mark.parametrize("most", [2, 1000])
def test_repeats_of_made_texts(spark, most):
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abc d"), 180))
    rows = []
    for number in range(40):
        noise = "".join(rng.choice(list("abcdefgh é"), rng.integers(0, 300)))
        cut, at = rng.integers(0, 80), rng.integers(0, len(noise) + 1)
        rows.append((number, noise[:at] + passage[cut : cut + rng.integers(60, 181)] + noise[at:]))
    rows += [(40, "ab" * 300), (41, "x" * 99), (42, "y" * 100), (43, "y" * 101), (44, None), (45, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _found_repeats(docs, most_contexts=most) == _brute_repeats(rows, 100)


def test_passage_in_many_documents_with_other_surroundings(spark):
    """Every document has the passage and, around it, other text each; chunks stay small on every level."""
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghijklm "))
    passage = "".join(rng.choice(letters, 300))
    rows = [(k, "".join(rng.choice(letters, 60)) + passage + "".join(rng.choice(letters, 60))) for k in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert _found_repeats(docs, most_contexts=40) == _brute_repeats(rows, 100)


def test_crowded_anchor_of_contexts_that_differ(spark, monkeypatch):
    """Contexts that share some 60 bytes and no window are not dealt out window by window."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklm "))
    middle = "".join(rng.choice(letters, 60))
    rows = [(k, "".join(rng.choice(letters, 80)) + middle + "".join(rng.choice(letters, 80))) for k in range(300)]
    dealt, sort = [], repeats._chunks_sorted
    monkeypatch.setattr(repeats, "_chunks_sorted", lambda contexts_of, *more: dealt.append(contexts_of.count()) or sort(contexts_of, *more))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _found_repeats(docs, most_contexts=20) == _brute_repeats(rows, 100)
    assert sum(dealt) < 300


def test_only_windows_with_a_like_are_sorted(monkeypatch):
    rng = np.random.default_rng(9)
    bodies = [rng.integers(0, 256, 150, np.uint8) for _ in range(50)]
    bodies[7][20:125] = bodies[3][10:115]
    sizes, order = [], repeats.suffix_order
    monkeypatch.setattr(repeats, "suffix_order", lambda text, depth: sizes.append(len(text)) or order(text, depth))
    numbers = np.arange(50)
    runs, left = repeats.repeated_windows(np.concatenate(bodies), np.arange(51) * 150, numbers, numbers % 2, numbers * 1000, 100)
    assert [column.tolist() for column in runs] == [[7], [1], [7020], [6]] and left.tolist() == list(range(50))
    assert sizes == [2 * 105]


def test_chunks_send_on_the_first_of_each_window(spark):
    """A window that stands in 3,000 places, in chunks of at most some forty rows, needs three levels."""
    body = bytes(range(100))
    rows = [(9, 5, 1_000, k, 0, k % 7, body) for k in range(3_000)]
    level, sizes, marked = spark.createDataFrame(rows, repeats._CONTEXTS), [], 0
    while not level.isEmpty():
        chunk = F.pmod(F.xxhash64("doc", "tie", "start"), F.col("parts"))
        sizes.append(level.groupBy("key", "sub", chunk).count().agg(F.max("count")).first()[0])
        found = repeats._chunks_sorted(level, 100, 40).collect()
        marked += sum(row["windows"] for row in found if row["windows"])
        rest = [(row["key"], row["sub"], row["parts"], row["doc"], row["tie"], row["start"], row["body"]) for row in found if row["windows"] is None]
        level = spark.createDataFrame(rest, repeats._CONTEXTS)
    assert marked == 2_999 and len(sizes) == 3 and max(sizes) < 90


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = repeats.remove_repeats(odd_docs).collect()
    assert len(rows) == 12
    found = {row["id"]: row["n_removed"] for row in rows}
    assert found[8] == next(row["n_bytes"] for row in rows if row["id"] == 8) and found[10] == 4999
    assert repeats.remove_repeats(no_docs).count() == 0


def _sets(rows, words):
    out = {}
    for number, text in rows:
        lowered = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
        parts = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        runs = [tuple(parts[k : k + words]) for k in range(len(parts) - words + 1)] or ([tuple(parts)] if parts else [])
        out[number] = frozenset(runs)
    return out


def _brute_components(sets):
    label = {number: number for number in sets}
    numbers = sorted(sets)

    def root(number):
        while label[number] != number:
            number = label[number]
        return number

    owners = {}
    for number in numbers:
        common = Counter(other for run in sets[number] for other in owners.get(run, ()))
        for other, count in common.items():
            if 100 * count >= 80 * (len(sets[number]) + len(sets[other]) - count):
                a, b = root(number), root(other)
                label[max(a, b)] = min(a, b)
        for run in sets[number]:
            owners.setdefault(run, []).append(number)
    return {number: root(number) for number in numbers}


@pytest.mark.parametrize("kinds", [{}, {"node": 3, "block": 3, "levels": 3}])
def test_components_of_documents(documents, kinds):
    sets = _sets([(row["doc_id"], row["text"]) for row in documents.collect()], 4)
    expected = _brute_components(sets)
    rows = near_dedup.near_duplicates(documents, settings=near_dedup.Settings(**kinds)).collect()
    assert {row["doc"]: row["n_shingles"] for row in rows} == {number: len(s) for number, s in sets.items()}
    assert {row["doc"]: row["component"] for row in rows} == expected


@pytest.mark.parametrize("kinds", [{}, {"node": 20, "block": 20, "levels": 2}])
def test_large_group_of_near_copies(spark, kinds):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for number in range(150):
        words = list(base)
        for place in rng.integers(0, 150, rng.integers(0, 12)):
            words[place] = f"n{rng.integers(0, 1 << 30)}"
        rows.append((number, " ".join(words)))
    sets = _sets(rows, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, settings=near_dedup.Settings(**kinds)).collect()
    assert {row["doc"]: row["component"] for row in found} == _brute_components(sets)


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    rows = near_dedup.op10_near_dedup(spark, odd_docs).collect()
    assert len(rows) == 12
    found = {row["doc_id"]: row for row in rows}
    assert found[1]["n_shingles"] == 0 and found[1]["kept"] and found[8]["component_id"] == 7
    assert found[5]["component_id"] is None and found[None]["kept"] and not found[4]["kept"]
    kept = near_dedup.without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(row["doc_id"]) for row in kept.collect()) == sorted(map(str, [1, 2, 3, 7, 9, 10, 11, None]))
    assert near_dedup.without_near_duplicates(no_docs).count() == 0


def test_rows_without_id_or_with_one_id_are_documents_of_their_own(spark):
    texts = [" ".join(f"w{number}x{k}" for k in range(30)) for number in range(12)]
    rows = [(None, text) for text in texts[:6]] + [(7, text) for text in texts[6:]]
    near = texts[0].replace("w0x29", "other")
    docs = spark.createDataFrame([*rows, (3, near), (2, texts[8])], "doc_id long, text string").repartition(3)
    found = near_dedup.op10_near_dedup(spark, docs).collect()
    assert sum(row["kept"] for row in found) == 12
    assert {row["doc_id"]: (row["component_id"], row["kept"]) for row in found if row["doc_id"] in (2, 3)} == {
        2: (2, True), 3: (None, False)
    }
    assert sorted(map(str, (row["component_id"] for row in found if row["doc_id"] == 7))) == ["2", "7", "7", "7", "7", "7"]
    kept = near_dedup.without_near_duplicates(docs).collect()
    assert sorted(row["text"] for row in kept) == sorted(texts)


def test_rows_of_one_id_get_their_own_marks(spark):
    passage = "z" + "".join(np.random.default_rng(1).choice(list("abc d"), 120))
    rows = 20_000
    made = spark.range(rows, numPartitions=4).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.concat(F.repeat(F.lpad(F.col("id").cast("string"), 6, "0"), 1), F.sha2(F.col("id").cast("string"), 512)).alias("text"),
    )
    twice = spark.createDataFrame([(number, passage) for number in range(2)], "doc_id long, text string")
    found = repeats.remove_repeats(made.unionByName(made.limit(rows // 2)).unionByName(twice))
    lost = sorted((row["n_removed"] for row in found.select("n_removed").collect()), reverse=True)
    assert lost == [134] * (rows // 2) + [121] + [0] * (rows + 1)


def test_pipeline_stages(spark, sf_dir, documents):
    """Each stage against brute force on what the stage before it kept."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    docs, kept = documents, [documents.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        kept.append(rows)
    start, told, exact, near, mixed, cut = kept
    assert {row["doc_id"] for row in told} == {row["doc_id"] for row in start if any(map(str.isalpha, row["text"] or ""))}
    last = {}
    for row in told:
        text = re.sub("[A-Z]", lambda found: found[0].lower(), row["text"])
        last[text] = max(last.get(text, -1), row["doc_id"])
    assert sorted(row["doc_id"] for row in exact) == sorted(last.values())
    sets = _sets([(row["doc_id"], row["text"]) for row in exact], 5)
    assert sorted(row["doc_id"] for row in near) == sorted(set(_brute_components(sets).values()))
    counts = Counter(row["doc_id"] for row in mixed)
    assert set(counts) <= {row["doc_id"] for row in near} and max(counts.values()) <= 2
    assert len(cut) == len(mixed) and all(row["lossless"] for row in cut)


def test_pipeline_runs(spark, sf_dir):
    frame = corpus_pipeline.run(spark, sf_dir)
    assert frame.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and frame.count() > 0
