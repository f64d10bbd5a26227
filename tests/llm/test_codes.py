"""Vector codes: curve, kernels, and whole results against a plain computation."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnscore.llm import codes


def plain(rows, settings=codes.Settings()):
    """Codes and errors by definition, in Python's integers; rows are (id, vector) of sound vectors."""
    rows = [(name, [int(np.floor(1024 * float(x))) for x in vector]) for name, vector in rows]
    length = len(rows[0][1])
    bounds = codes.part_bounds(length, settings.parts)
    first = [v for _, v in sorted(rows, key=lambda row: (row[0] is None, row[0], row[1]))][: settings.entries]
    books = [[v[a:b] for v in first] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)), k) for k, entry in enumerate(book))

    for _ in range(settings.rounds):
        for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            groups = {}
            for _, v in rows:
                groups.setdefault(nearest(v[a:b], books[p])[1], []).append(v[a:b])
            for k, parts in groups.items():
                books[p][k] = [sum(column) // len(parts) for column in zip(*parts, strict=True)]
    result = []
    for name, v in rows:
        best = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
        result.append((name, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return result, hashlib.sha256(text.encode()).hexdigest()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_curve_visits_every_cell_by_single_steps():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2), (1, 5)):
        grid = np.indices([1 << bits] * dimensions).reshape(dimensions, -1).T
        keys = codes.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


@pytest.mark.parametrize("scale", [50, 1 << 27, 1 << 53])
def test_kernels_agree_with_all_pairs(scale):
    random = np.random.default_rng(5)
    entries = random.integers(-scale, scale, (20, 3), endpoint=True)
    entries[7] = entries[3]
    values = np.concatenate([random.integers(-scale, scale, (60, 3)), entries[:5]])
    book = codes.Codebook(entries)
    listed = book.shortlist(values.min(axis=0), values.max(axis=0))
    chosen, error = book.nearest(values, listed)
    for row, k, d in zip(values.tolist(), chosen, error, strict=True):
        expected = min((sum((x - y) ** 2 for x, y in zip(row, entry, strict=True)), n) for n, entry in enumerate(entries.tolist()))
        assert (int(d), int(k)) == expected


def test_shortlist_drops_far_entries():
    book = codes.Codebook(np.array([[0, 0], [1000, 1000], [3, 3]]))
    assert book.shortlist(np.array([0, 0]), np.array([2, 2])).tolist() == [0, 2]


def test_whole_result_with_ties_repeats_and_unsound_rows(spark):
    random = np.random.default_rng(3)
    rows = [(int(k), [float(x) for x in random.normal(0, 0.2, 10).astype(np.float32)], k % 3 or None) for k in range(400)]
    rows += [rows[5]] * 40 + [(None, rows[9][1], None), (7, rows[11][1], 1)]
    bad = [(900, None, 1), (901, [float("nan")] * 10, 1), (902, [float("inf")] * 10, None), (903, [None] * 10, 2), (904, [1.0], 2)]
    settings = codes.Settings(entries=16, rounds=3)
    found, books = codes.compress(vectors(spark, rows + bad), "vec_id", "embedding", settings)
    expected, digest = plain([row[:2] for row in rows], settings)
    key = lambda row: (row[0] is None, row)
    assert sorted((tuple(row) for row in found.collect()), key=key) == sorted(expected, key=key)
    assert codes.books_digest(books) == digest


def test_query_with_few_rows_and_labels(spark):
    rows = [(3, [0.5, -0.25, 3.0, 1e-9], None), (1, [0.5, -0.25, 3.0, -1e-9], 7), (2, [9.0, 9.0, 9.0, 9.0], 7)]
    found = {row["vec_id"]: row for row in codes.op12_vector_codes(spark, vectors(spark, rows)).collect()}
    expected, digest = plain([row[:2] for row in rows])
    labels = {name: label for name, _, label in rows}
    for name, code, error in expected:
        assert (found[name]["code"], found[name]["error"], found[name]["codebooks_sha256"]) == (code, error, digest)
        assert found[name]["label_error"] == sum(e for other, _, e in expected if labels[other] == labels[name])


def test_huge_components_and_long_errors(spark):
    rows = [(k, [3e38 * (-1) ** k, 1.0, float(k), 0.0], 1) for k in range(300)]
    found = codes.op12_vector_codes(spark, vectors(spark, rows)).collect()
    assert len(found) == 300 and all(0 <= row["error"] <= codes.LONGEST for row in found)


def test_no_rows_no_components_and_clashing_names(spark):
    assert codes.op12_vector_codes(spark, vectors(spark, [])).collect() == []
    assert codes.op12_vector_codes(spark, vectors(spark, [(1, None, 1)])).collect() == []
    empty = codes.op12_vector_codes(spark, vectors(spark, [(1, [], 1), (2, [], None)])).collect()
    assert [(row["code"], row["error"]) for row in empty] == [("00000000", 0)] * 2
    odd = vectors(spark, [(k, [float(k)] * 4, 1) for k in range(5)]).withColumns(
        {name: F.lit(1) for name in ("id", "ints", "number", "keep0", "part", "size", "is_hot", "_file", "_number")}
    )
    assert codes.op12_vector_codes(spark, odd).count() == 5
