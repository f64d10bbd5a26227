"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, twice as long as the template it is compared with, and there is one every
template's length, so a notice of up to that length lies whole in a window however its lines are broken, and words that
are scattered over a text meet in none. A block meets a template when it contains at least a given part of the template's
words. The template words are put in one global order, those of the fewest documents first. Any block that meets the
threshold must contain one of the first ``n - needed + 1`` words of the template (prefix), so only windows around such
words are made, each once, at its first hit. They must have at least ``needed`` words of any template (length), and
behind the hit enough words must be left in the order of both the window and the template (position). What passes is
compared in full. Texts are cut into words once; after that a word is its number among the template words. The templates
are a given list, so their index has a fixed size and is broadcast.

Defined results: a null text is empty and has no words, no places and no labels; repeated rows each get a result.
An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.common import addressed, ascii_lower, whole_text
from txnscore.workspace import written

#: What parts words, after A-Z is lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Usual license notices and the label of each. Fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
)


def template_words(text: str) -> list[str]:
    return sorted({word for word in re.split(GAP, text.lower()) if word})


@dataclass(frozen=True)
class Template:
    """Words of a template by their numbers, its length with repeats, and how many different ones a block needs."""

    label: str
    words: tuple[int, ...]
    length: int
    needed: int


def numbered_templates(
    templates: Sequence[tuple[str, str]], threshold: float
) -> tuple[list[str], list[Template]]:
    """All words of the templates, numbered from 1, and the templates."""
    sets = [template_words(text) for _, text in templates]
    vocabulary = sorted({word for words in sets for word in words})
    number = {word: k for k, word in enumerate(vocabulary, 1)}
    made = [
        Template(
            label,
            tuple(number[word] for word in words),
            len([word for word in re.split(GAP, text.lower()) if word]),
            max(1, math.ceil(threshold * len(words) - 1e-9)),
        )
        for (label, text), words in zip(templates, sets, strict=True)
    ]
    return vocabulary, made


def word_numbers(plain: Column, vocabulary: Sequence[str]) -> Column:
    """The number of each word of a text whose words stand between single spaces; 0 for words of no template."""
    words = F.filter(F.split(plain, " "), lambda word: word != "")
    known = F.lit(list(vocabulary))
    number = lambda word: F.when(word.isin(list(vocabulary)), F.array_position(known, word)).otherwise(F.lit(0))
    return F.transform(words, lambda word: number(word).cast("short"))


def word_order(numbers: DataFrame, size: int) -> list[int]:
    """Word numbers, those of the fewest documents first. One row per word of the templates is collected."""
    present = F.array_distinct(F.filter("_words", lambda word: word > 0))
    counts = {row["word"]: row["count"] for row in numbers.select(F.explode(present).alias("word")).groupBy("word").count().collect()}
    return sorted(range(1, size + 1), key=lambda word: (counts.get(word, 0), word))


_HIT = "word short, template int, label string, place int, needed int, length int, ranked array<short>"


def windows(numbers: DataFrame, order: Sequence[int], templates: Sequence[Template]) -> DataFrame:
    """The windows that have a hit in the prefix of a template, each at its first hit, with what the filters look at.

    ``_file``, ``_row``, ``_block`` (the window's number), ``template``, ``label``, ``needed``, ``ranked`` (the template's
    words in order), ``own`` (the window's template words), ``length_left`` and ``position_left``: how many words the
    length and the position filter leave possible.
    """
    place = {word: k for k, word in enumerate(order)}
    index = []
    for number, template in enumerate(templates):
        ranked = sorted(template.words, key=place.__getitem__)
        for at in range(len(ranked) - template.needed + 1):
            index.append((ranked[at], number, template.label, at, template.needed, template.length, ranked))
    frame = F.broadcast(numbers.sparkSession.createDataFrame(index, _HIT))  # a row per word of the given templates
    most = 2 * max(template.length for template in templates)
    first_words = sorted({row[0] for row in index})
    hits = F.filter(
        F.transform("_words", lambda word, at: F.struct(word.alias("word"), at.alias("at"))),
        lambda hit: hit["word"].isin(first_words),
    )
    # A hit takes only the words around it along.
    near = F.transform(
        hits,
        lambda hit: F.struct(
            hit["word"].alias("word"),
            hit["at"].alias("at"),
            F.greatest(hit["at"] - most, F.lit(0)).alias("from"),
            F.slice("_words", F.greatest(hit["at"] - most, F.lit(0)) + 1, F.lit(2 * most + 1)).alias("near"),
        ),
    )
    found = numbers.select("_file", "_row", F.explode(near).alias("hit")).select("_file", "_row", "hit.*").join(frame, "word")
    last = F.floor(F.col("at") / F.col("length")).cast("int")
    found = found.withColumn("_block", F.explode(F.array(last - 1, last))).where("_block >= 0")
    begin = F.col("_block") * F.col("length")
    found = found.withColumn("window", F.slice("near", begin - F.col("from") + 1, 2 * F.col("length")))
    # The first prefix word in order, at its first place.
    found = found.where(
        (F.array_position("window", F.col("word")) == F.col("at") - begin + 1)
        & ~F.arrays_overlap("window", F.slice("ranked", F.lit(1), F.col("place")))
    )
    ranks = F.lit([place.get(word, -1) for word in range(len(order) + 1)])
    rank = lambda word: F.element_at(ranks, word.cast("int") + 1)
    own = F.array_distinct(F.filter("window", lambda word: word > 0))
    behind = F.size(F.filter("own", lambda word: rank(word) > rank(F.col("word"))))
    return found.withColumn("own", own).select(
        "_file", "_row", "_block", "template", "label", "needed", "ranked", "own",
        F.size("own").alias("length_left"),
        (F.lit(1) + F.least(F.size("ranked") - F.col("place") - 1, behind)).alias("position_left"),
    )


def matches(numbers: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Every block that meets a template: ``_file``, ``_row``, ``_block``, ``template``, ``label``, ``containment``.

    ``numbers`` has the words of each text as ``_words`` and its address, see ``common.addressed``.
    """
    order = word_order(numbers, max(word for template in templates for word in template.words))
    possible = windows(numbers, order, templates).where("length_left >= needed and position_left >= needed")
    overlap = F.size(F.array_intersect("own", "ranked"))
    return possible.where(overlap >= F.col("needed")).select(
        "_file", "_row", "_block", "template", "label", (overlap / F.size("ranked")).alias("containment")
    )


def phrase_columns(text: Column, phrases: Mapping[str, str] = PHRASES) -> dict[str, Column]:
    """Counts, first and last place and labels of the phrases, whose words stand consecutively in the text."""
    plain = F.regexp_replace(F.concat(F.lit(" "), ascii_lower(text), F.lit(" ")), GAP, " ")
    line = F.col("_plain")
    words_in = lambda part: (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))).cast("long")
    counts = [F.regexp_count(line, F.lit(f" {phrase}(?= )")) for phrase in phrases]
    firsts = [F.nullif(F.instr(line, f" {phrase} "), F.lit(0)) for phrase in phrases]
    lasts = [
        F.nullif(F.instr(F.reverse(line), f" {phrase[::-1]} "), F.lit(0)) + F.lit(len(phrase) + 1) for phrase in phrases
    ]
    start = F.array_min(F.array(*firsts))
    end = F.length(line) - F.array_min(F.array(*lasts)) + 1
    return {
        "_plain": plain,
        "n_words": words_in(line) - 1,
        "n_base": sum(counts[1:], counts[0]).cast("long"),
        "first_word": F.when(F.col("n_base") > 0, words_in(F.substring(line, F.lit(1), start)) - 1),
        "last_word": F.when(F.col("n_base") > 0, words_in(F.substring(line, F.lit(1), end)) - 1),
        "_base": F.filter(
            F.array(*[F.when(F.instr(line, f" {phrase} ") > 0, F.lit(label)) for phrase, label in phrases.items()]),
            lambda label: label.isNotNull(),
        ),
    }


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document with its phrases, its labels and the best containment of a template."""
    vocabulary, made = numbered_templates(templates, threshold)
    scanned = addressed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    for name, column in phrase_columns(whole_text("text")).items():
        scanned = scanned.withColumn(name, column)
    scanned = scanned.withColumn("_words", word_numbers(F.col("_plain"), vocabulary)).drop("_plain", "text")
    scanned = written(scanned, "words")
    found = matches(scanned.select("_file", "_row", "_words"), made).groupBy("_file", "_row").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_containment")
    )
    joined_text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    none = F.array().cast("array<string>")
    return scanned.drop("_words").join(found, ["_file", "_row"], "left").select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined_text(F.col("_base")).alias("base_labels"),
        joined_text(F.concat("_base", F.coalesce("_labels", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_containment", F.lit(0.0))).alias("score"),
    )


def op9_license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return license_scan(docs)
