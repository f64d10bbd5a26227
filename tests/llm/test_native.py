"""Exact dedup, mixing, fingerprints and license scan."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from compare import connect, differences
from txnscore.llm import components, exact_dedup, fingerprints, licenses, mixing
from txnscore.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(entry_point.queries()[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_exact_groups(odd_docs):
    rows = exact_dedup.exact_duplicates(odd_docs).collect()
    assert len(rows) == 12
    hello = [row for row in rows if row["group_size"] == 4]
    assert len(hello) == 4 and {row["keep_id"] for row in hello} == {5}
    assert sum(row["kept"] for row in hello) == 1
    empty = [row for row in rows if row["id"] in (1, 2)]
    assert {row["keep_id"] for row in empty} == {2} and {row["group_size"] for row in empty} == {2}
    assert empty[0]["digest"] == hashlib.sha256(b"").hexdigest()


def test_repeated_row_is_kept_once(spark):
    docs = spark.createDataFrame([(4, "a"), (4, "a"), (4, "a")], "doc_id long, text string")
    kept = exact_dedup.without_duplicates(docs)
    assert [tuple(row) for row in kept.collect()] == [(4, "a")]


def test_colliding_digests_are_told_apart(spark):
    docs = spark.createDataFrame([(k, f"text {k // 2}") for k in range(40)], "doc_id long, text string")
    short = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    rows = exact_dedup.exact_duplicates(docs, digest=short).collect()
    assert sorted((row["id"], row["keep_id"], row["group_size"]) for row in rows) == [
        (k, k // 2 * 2 + 1, 2) for k in range(40)
    ]


def test_exact_dedup_keeps_columns(odd_docs, no_docs):
    kept = exact_dedup.without_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 7
    assert exact_dedup.without_duplicates(no_docs).count() == 0


def test_mix_levels(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 50), ("d", 0)], "source string, source_size long")
    rows = {row["source"]: row for row in mixing.targets(sizes).collect()}
    assert [rows[name]["weight"] for name in ("a", "b", "c", "d", None)] == [3, 1, 2, 3, 1]
    assert rows["c"]["target"] == 20 and rows["a"]["target"] == 200 and rows["d"]["target"] == 0
    assert sum(row["target"] for row in rows.values()) == pytest.approx(1.5 * 1160)
    assert all(row["target"] <= 2 * row["source_size"] for row in rows.values())


def test_mix_of_odd_rows(odd_docs, no_docs):
    mixed = mixing.mixed(odd_docs)
    assert mixed.columns == odd_docs.columns
    first, again = (sorted(str(row) for row in mixing.mixed(odd_docs).collect()) for _ in range(2))
    assert first == again and all(row["text"] and row["text"].strip() for row in mixed.select("text").collect())
    assert mixing.mixed(no_docs).count() == 0


def test_mix_comes_near_its_targets(spark, documents):
    rows = mixing.op4_mixing(spark, documents).collect()
    assert all(row["taken"] <= 2 * row["size"] for row in rows)
    assert sum(row["taken"] for row in rows) == pytest.approx(1.5 * sum(row["size"] for row in rows), rel=0.1)


def _next_by_id(rows):
    order = sorted(rows, reverse=True)
    return {one: order[(k + 1) % len(order)] for k, one in enumerate(order)}


def test_edited_texts(spark, documents):
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    follow = _next_by_id(texts)
    found = fingerprints.op7_fingerprints(spark, documents).collect()
    assert len(found) == len(texts)
    prints = {row["doc_id"]: row["fingerprint"] for row in found}
    for row in found:
        text, half = texts[row["doc_id"]], len(texts[row["doc_id"]]) // 2
        edited = text[: len(text) - half] + texts[follow[row["doc_id"]]][:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        apart = (int(row["fingerprint"], 16) ^ int(prints[follow[row["doc_id"]]], 16)).bit_count()
        assert row["near_next"] == 1 - apart / 128
    longer = [row for row in found if row["n_chars"] > 2000]
    assert sum(row["near_edited"] > row["near_next"] for row in longer) >= 0.95 * len(longer)


def test_fingerprint_votes(spark):
    text = "one two three four five six seven one two three four five"
    words = text.split()
    docs = spark.createDataFrame([(1, text), (2, text), (3, "")], "id long, text string")
    hashes = docs.where("id = 1").select(fingerprints.shingle_hashes(F.col("text")).alias("h")).first()["h"]
    assert len(hashes) == len(words) - 4 and hashes[0] == hashes[-1]
    rows = fingerprints.fingerprints(docs.withColumn("_hashes", fingerprints.shingle_hashes(F.col("text"))), "id")
    found = {row["id"]: (row["hi"], row["lo"]) for row in rows.collect()}
    expected = sum(
        1 << bit for bit in range(64) if 2 * sum((h >> bit) & 1 for h in (x % 2**64 for x in hashes)) > len(hashes)
    )
    assert found[1][0] % 2**64 == expected and found[1] == found[2] and found[3] == (0, 0)


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = fingerprints.document_fingerprints(odd_docs).collect()
    assert len(rows) == 12
    assert len({row["fingerprint"] for row in rows if row["n_chars"] == 29 and row["doc_id"] != 5}) == 1
    assert [row["near_next"] for row in rows if row["doc_id"] is None] == [None]
    assert fingerprints.document_fingerprints(no_docs).count() == 0


def test_near_fingerprints_are_all_tied(spark):
    import random

    rng = random.Random(4)
    base = [rng.getrandbits(128) for _ in range(20)]
    rows, number = [], 0
    for value in base:
        for _ in range(8):
            flips = sum(1 << bit for bit in rng.sample(range(128), rng.randrange(0, 5)))
            rows.append((number, value ^ flips))
            number += 1
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    frame = spark.createDataFrame(
        [(k, signed(value >> 64), signed(value % 2**64)) for k, value in rows], "id long, hi long, lo long"
    )
    label = list(range(number))
    changed = True
    while changed:
        changed = False
        for i in range(number):
            for j in range(i):
                if (rows[i][1] ^ rows[j][1]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    classes = {(row["hi"], row["lo"]): row["class_id"] for row in fingerprints.near_classes(frame).collect()}
    found = [classes[signed(value >> 64), signed(value % 2**64)] for _, value in rows]
    assert found == label


def test_components(spark):
    links = [(k, k + 1) for k in range(10, 40)] + [(1, 2), (2, 3), (3, 1), (50, 50), (60, 61), (60, 61)]
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {row["id"]: row["component"] for row in rows}
    assert found == {**{k: 10 for k in range(10, 41)}, 1: 1, 2: 1, 3: 1, 60: 60, 61: 60}


def test_phrases(spark):
    texts = {
        1: "cc by cc by MIT License. mit-license, gnu general  public\nlicense",
        2: "the mitt license",
        3: None,
        4: "Released under the MIT License.",
        5: "This program is free software: you may redistribute it and modify it under the terms of the GNU Public License",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in licenses.license_scan(docs).collect()}
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"]) == (5, 0, 8)
    assert rows[1]["base_labels"] == "cc-by,gpl,mit"
    assert rows[2]["n_base"] == 0 and rows[2]["base_labels"] == "" and rows[2]["first_word"] is None
    assert (rows[3]["n_words"], rows[3]["score"], rows[3]["labels"]) == (0, 0.0, "")
    assert rows[4]["labels"] == "mit" and rows[4]["score"] == 1.0
    assert rows[5]["n_base"] == 0 and rows[5]["labels"] == "gpl" and 0.8 <= rows[5]["score"] < 1


def _numbered(rows, templates, threshold):
    vocabulary, made = licenses.numbered_templates(templates, threshold)
    plain = licenses.phrase_columns(F.coalesce("text", F.lit("")))["_plain"]
    return rows.withColumn("_words", licenses.word_numbers(plain, vocabulary)), made


def test_license_join_finds_every_block(spark, documents):
    """The prefix, length and position filters lose no block that brute force finds, and each removes some."""
    templates, threshold = licenses.TEMPLATES, 0.4
    rows, made = _numbered(licenses.addressed(documents.select("doc_id", "text")), templates, threshold)
    found = licenses.matches(rows, made).join(rows, ["_file", "_row"])
    got = [(row["doc_id"], row["_block"], row["template"]) for row in found.collect()]
    expected, every = set(), 0
    for row in documents.collect():
        words = [word for word in re.split(licenses.GAP, licenses_lower(row["text"])) if word]
        for k, (_, text) in enumerate(templates):
            own, size = set(licenses.template_words(text)), made[k].length
            for block in range(-(-len(words) // size)):
                every += 1
                if len(own & set(words[block * size : (block + 2) * size])) >= threshold * len(own) - 1e-9:
                    expected.add((row["doc_id"], block, k))
    assert len(got) == len(set(got)) and set(got) == expected and expected
    order = licenses.word_order(rows, max(word for template in made for word in template.words))
    left = licenses.windows(rows, order, made)
    kept = [left, left.where("length_left >= needed"), left.where("length_left >= needed and position_left >= needed")]
    counts = [every, *(frame.count() for frame in kept), len(expected)]
    assert counts == sorted(counts, reverse=True) and len(set(counts)) == len(counts)


def test_wrapped_notices_are_found_and_scattered_words_are_not(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\n * modification, are permitted"
    cc0 = "To the extent possible under law, the author has waived all copyright and\n related rights to this work"
    filler = [f"word{k}" for k in range(9_000)]
    for at, word in ((100, "released"), (2_000, "under"), (5_000, "the"), (8_900, "license")):
        filler[at] = word
    texts = [f"{'lead in ' * 40}{bsd}. more", f"# {cc0}", " ".join(filler), "Released under\nthe\n\tMIT license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in licenses.license_scan(docs).collect()}
    assert [rows[k]["labels"] for k in range(4)] == ["bsd", "cc0", "", "mit"]
    assert rows[2]["score"] == 0.0 and rows[0]["score"] == 1.0


def licenses_lower(text):
    return re.sub("[A-Z]", lambda found: found[0].lower(), text or "")


def test_license_scan_of_odd_rows(odd_docs, no_docs):
    assert licenses.license_scan(odd_docs).count() == 12
    assert licenses.license_scan(no_docs).count() == 0


def test_crowded_buckets_lose_no_link(spark):
    """Fingerprints that share most bits crowd the buckets; cut or not, exactly the near ones are tied."""
    draw = random.Random(5)
    base = draw.getrandbits(128)
    values = {base ^ sum(1 << bit for bit in draw.sample(range(70), draw.choice((0, 2, 5, 9)))) for _ in range(300)}
    values = sorted(values)
    signed = lambda half: half - (1 << 64) if half >> 63 else half
    rows = [(n, signed(value >> 64), signed(value & (1 << 64) - 1)) for n, value in enumerate(values)]
    members = spark.createDataFrame(rows, "member long, hi long, lo long")
    near = {
        (a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= fingerprints.RADIUS
    }

    def classes(links):
        parent = list(range(len(values)))

        def root(n):
            while parent[n] != n:
                n = parent[n]
            return n

        for a, b in links:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
        return [root(n) for n in range(len(values))]

    assert 1 < len(set(classes(near))) < len(values)
    for crowd in (1, 8, 1000):
        links = {tuple(row) for row in fingerprints.near_links(members, crowd=crowd).collect()}
        assert all((max(pair), min(pair)) in near for pair in links) and classes(links) == classes(near)


@pytest.mark.parametrize("ids", [[7], [1, 2, 3], [5, -9, 10**18, 0, -(10**18)], [k * 10**12 for k in range(500)]])
def test_next_ids_go_round(spark, ids):
    frame = spark.createDataFrame([(one,) for one in [*ids, ids[0]]], "id long")
    order = sorted(ids)
    found = {row["id"]: row["next_id"] for row in fingerprints.next_ids(frame).collect()}
    assert found == {one: order[place - 1] for place, one in enumerate(order)}
