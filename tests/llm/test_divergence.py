"""Source divergence: transducers, cutting of texts, and whole results against a plain computation."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnscore.llm import divergence, transducer
from txnscore.llm.divergence import Settings

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, settings):
    """The result by definition; rows are (lang, source, text)."""
    rows = [tuple(value or "" for value in row) for row in rows]
    seen, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall(lower(text))
        seen[lang].update(set(terms))
        groups[lang, source].update(terms)
    result = []
    for lang in {lang for lang, _ in groups}:
        kept = sorted((t for t, n in seen[lang].items() if n >= settings.documents), key=str.encode)
        count = {s: [found[t] for t in kept] for (own, s), found in groups.items() if own == lang}
        share = lambda n: [1 + 10**9 * (x + settings.smoothing) // (sum(n) + settings.smoothing * len(kept)) for x in n]
        p = {s: share(n) for s, n in count.items()}
        q = share([sum(column) for column in zip(*count.values(), strict=True)])
        for s in p:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o.encode()) for o in p if o != s]
            terms = [(b - a, t.encode()) for t, n, a, b in zip(kept, count[s], p[s], q, strict=True) if n and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, settings.ranks)):
                result += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(found)[:most])]
    return sorted(result)


def check(spark, rows, settings, schema="lang string, source string, text string"):
    docs = spark.createDataFrame(rows, schema)
    found = divergence.divergence(docs, "lang", "source", "text", settings)
    assert sorted(tuple(row) for row in found.collect()) == plain(rows, settings)


def test_ordinals_and_minimality():
    picked = random.Random(4)
    keys = sorted({bytes(picked.choices(b"abc\xc3", k=picked.randrange(0, 7))) for _ in range(400)})
    made = transducer.build(keys)
    # As many states as there are different sets of endings.
    endings = {frozenset(k[len(p):] for k in keys if k.startswith(p)) for k in keys for p in (k[:n] for n in range(len(k) + 1))}
    assert len(made.final) == len(endings) and made.size == len(keys)
    runner = transducer.Runner(made)
    probes = keys + [key + b"x" for key in keys] + [key[:-1] + b"\x00" for key in keys if key]
    data = np.frombuffer(b"".join(probes), np.uint8)
    ends = np.cumsum([len(key) for key in probes])
    begin = np.full(len(probes), made.root), np.zeros(len(probes), np.int64)
    hit, ordinals = runner.ordinals(data, ends - [len(key) for key in probes], ends, *begin)
    found = {probes[k]: n for k, n in zip(hit, ordinals, strict=True)}
    assert found == {key: n for n, key in enumerate(keys)}


def test_empty_and_unordered_keys():
    assert transducer.build([]).size == 0
    assert transducer.Runner(transducer.build([])).start(b"a")[0] == -1
    assert transducer.build([b""]).size == 1
    for keys in ([b"b", b"a"], [b"a", b"a"], [b"", b""]):
        with pytest.raises(ValueError):
            transducer.build(keys)


def test_prefixes_order_as_languages():
    names = ["", "a", "a\x00", "a\x00b", "a\x01", "a\x01b", "ab", "b", "ä"]
    prefixes = [divergence.language_prefix(name) for name in sorted(names, key=str.encode)]
    assert prefixes == sorted(prefixes)
    assert not any(a != b and b.startswith(a) for a in prefixes for b in prefixes)


def test_stretches_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "STRETCH", 16)
    texts = [b"ab cd", b"", b"one two three four five six", b"x" * 50 + b" y " + b"z" * 20, b"end"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
    found = Counter()
    for first, last, own, places in divergence.stretches(data, starts):
        assert places[0] == 0 and places[-1] == len(own) and len(places) == last - first + 1
        for k in range(first, last):
            found.update((k, term) for term in divergence.TERM.findall(own[places[k - first] : places[k - first + 1]].tobytes()))
    assert found == Counter((k, term) for k, text in enumerate(texts) for term in divergence.TERM.findall(text))


def test_odd_rows(spark):
    rows = [
        ("en", "a", "The the THE cat, ÄÖ äö 日本語 x1y2z"), ("en", "a", "the cat the dog"), ("en", "b", "the dog; dog"),
        ("en", None, "the the"), (None, "a", "the cat"), ("", "", "the"), ("en", "c", None), ("en", "c", ""),
        ("fr", "a", "seul"), ("e", "n\x00", "the"), ("e\x00n", "x", "the the"), ("en", "b", "the dog; dog"),
        ("long", "a", "word " * 300_000 + "q" * 200_000), ("long", "b", "word " + "q" * 200_000), ("de", "x", "kein"),
    ]
    check(spark, rows, Settings(documents=2, ranks=3))
    check(spark, rows, Settings(documents=1, shard_terms=6, sent_bytes=600))
    check(spark, rows, Settings(documents=99))


def test_many_sources_and_blocks(spark):
    """More sources than a tile and more terms than a block."""
    picked = random.Random(8)
    words = ["".join(picked.choices("abcdefg", k=3)) for _ in range(150)]
    rows = [("l", f"s{k % 70:02}", " ".join(picked.choices(words, k=12))) for k in range(400)]
    rows += [("l", "s00", " ".join(words))] * 3 + [("m", f"s{k}", "solo") for k in range(3)]
    check(spark, rows, Settings(documents=3, ranks=5, tile=16, block=32))


def test_empty_table_and_clashing_names(spark):
    names = ["part", "item", "value", "rank", "ordinal", "place", "body", "term", "n", "total", "first"]
    schema = "lang string, source string, text string, " + ", ".join(f"{name} long" for name in names)
    assert divergence.op13_source_divergence(spark, spark.createDataFrame([], schema)).collect() == []
    rows = [("en", f"s{k % 3}", "some words here", *range(len(names))) for k in range(90)]
    docs = spark.createDataFrame(rows, schema)
    found = sorted(tuple(row) for row in divergence.op13_source_divergence(spark, docs).collect())
    assert found == plain([row[:3] for row in rows], Settings())
    assert docs.select(F.max("rank")).first()[0] == 3
