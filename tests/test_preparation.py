"""Splitting, scaling and weighing."""

import hashlib
import math
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnscore.operators import preparation as prep


def part_sizes(spark, sizes, fraction):
    frame = spark.createDataFrame(list(sizes.items()), "class string, n long")
    return {row["class"]: row["wanted"] for row in prep.part_sizes(frame, fraction).collect()}


def test_part_sizes_of_the_published_run(spark):
    sizes = part_sizes(spark, {"=0": 284_315, "=1": 492}, 0.2)
    assert sizes == {"=0": 56_864, "=1": 98}
    assert sum(sizes.values()) == 56_962


@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 10_000), min_size=1), st.sampled_from([0.1, 0.2, 0.25, 0.5]))
@settings(max_examples=15, deadline=None)
def test_part_sizes_add_up(spark, sizes, fraction):
    parts = part_sizes(spark, sizes, fraction)
    assert sum(parts.values()) == math.ceil(sum(sizes.values()) * fraction)
    assert all(abs(parts[name] - size * fraction) <= 2 for name, size in sizes.items())


def labelled(spark, n, fraud_every):
    return spark.range(n).select(F.col("id").alias("transaction_id"), (F.col("id") % fraud_every == 0).cast("int").alias("Class"))


def expected_test_ids(spark, n, fraud_every, fraction=0.2):
    classes = {0: [], 1: []}
    for i in range(n):
        classes[int(i % fraud_every == 0)].append(i)
    sizes = part_sizes(spark, {str(c): len(ids) for c, ids in classes.items()}, fraction)
    digest = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    return {i for c, ids in classes.items() for i in sorted(ids, key=digest)[: sizes[str(c)]]}


@pytest.mark.parametrize("n, fraud_every", [(10, 3), (1_000, 7), (20_000, 500)])
def test_exact_split_takes_the_smallest_hashes(spark, n, fraud_every):
    split = prep.stratified_split(labelled(spark, n, fraud_every))
    found = {row["transaction_id"] for row in split.where("split = 'test'").collect()}
    assert found == expected_test_ids(spark, n, fraud_every)


def test_split_does_not_depend_on_partitioning(spark):
    df = labelled(spark, 3_000, 11)
    one, many = (prep.stratified_split(df.repartition(k)).where("split = 'test'") for k in (1, 13))
    assert one.exceptAll(many).count() == 0 and one.count() == many.count() == 600


def test_split_of_an_empty_table(spark):
    assert prep.stratified_split(labelled(spark, 0, 2)).count() == 0


def test_split_keeps_unlabelled_rows(spark):
    df = labelled(spark, 100, 4).withColumn("Class", F.when(F.col("transaction_id") >= 10, F.col("Class")))
    split = prep.stratified_split(df)
    assert split.count() == 100 and split.where("split = 'test'").count() == 20


@pytest.mark.parametrize("most", [100_000, 10])
def test_split_by_ten_thousand_classes(spark, monkeypatch, most):
    """Some classes have a row, some thousands; their shares are sent to the tasks or joined by a shuffle."""
    monkeypatch.setattr(prep, "_BROADCAST_CLASSES", most)
    ids = spark.range(30_000).selectExpr("id AS transaction_id", "if(id < 10000, id, id % 3) AS Class")
    rows = {row["transaction_id"]: (row["Class"], row["split"]) for row in prep.stratified_split(ids).collect()}
    sizes, digest = {}, lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    for name, _ in rows.values():
        sizes[f"={name}"] = sizes.get(f"={name}", 0) + 1
    wanted = part_sizes(spark, sizes, 0.2)
    assert len(rows) == 30_000 and len(sizes) == 10_000 and sum(wanted.values()) == 6_000
    for name in (0, 1, 2, 17, 9_999):
        own = sorted((i for i, (c, _) in rows.items() if c == name), key=digest)
        assert [i for i in own if rows[i][1] == "test"] == own[: wanted[f"={name}"]]
    assert sum(split == "test" for _, split in rows.values()) == 6_000


def test_facts_take_one_scan(spark, tmp_path):
    df = spark.range(1_000).selectExpr("double(id) Time", "double(id % 7) V1", "cast(id % 10 = 0 AS int) Class")
    df = df.unionAll(spark.createDataFrame([(None, float("nan"), None)], "Time double, V1 double, Class int"))
    facts = prep.fit_facts(df, ["Time", "V1"], ["Time"])
    assert (facts.legitimate, facts.fraud, facts.fraud_weight) == (900, 100, 9.0)
    assert facts.medians["Time"] == pytest.approx(499.5, abs=3) and facts.medians["V1"] == 3.0
    assert facts.scales["Time"].mean == pytest.approx(499.5)
    nothing = prep.fit_facts(df.limit(0), ["Time", "V1"], ["Time"])
    assert nothing == prep.Facts({"Time": 0.0, "V1": 0.0}, {"Time": prep.Scale(0.0, 1.0)}, 0, 0)


def test_facts_of_the_same_rows_are_the_same(spark):
    """Far more rows than a summary holds, with gaps: no median is left to chance."""
    df = spark.range(0, 60_000, 1, 8).selectExpr("nullif(id * 7919 % 60000, 5) / 7 Time", "sin(id) V1", "cast(id % 10 = 0 AS int) Class")
    found = [prep.fit_facts(df, ["Time", "V1"], ["Time"]) for _ in range(4)]
    assert found.count(found[0]) == 4
    assert found[0].medians["Time"] == pytest.approx(30_000 / 7, abs=60 / 7) and abs(found[0].medians["V1"]) < 0.01


def test_copies_of_an_id_stay_together(spark):
    df = labelled(spark, 300, 3)
    both = prep.stratified_split(df.unionAll(df))
    assert both.groupBy("transaction_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


def test_hash_split_is_near_the_fraction(spark):
    n = prep.hash_split(spark.range(20_000), "id").where("split = 'test'").count()
    assert abs(n - 4_000) < 250


def test_scale_is_the_population_deviation(spark):
    data = [1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame([(x, 5.0) for x in data] + [(None, 5.0), (float("nan"), 5.0)], "a double, b double")
    scales = prep.fit_scale(df, ["a", "b"])
    assert scales["a"].mean == pytest.approx(statistics.fmean(data))
    assert scales["a"].deviation == pytest.approx(statistics.pstdev(data))
    assert scales["b"] == prep.Scale(5.0, 1.0)


def test_preparation_fills_and_scales(spark):
    df = spark.createDataFrame([(1.0, 10.0), (3.0, None), (None, 30.0), (float("nan"), 20.0)], "Time double, V1 double")
    stage = prep.fit_preparation(df, ["Time", "V1"], ["Time"])
    rows = stage.transform(df).collect()
    assert [row["prepared_Time"] for row in rows] == [-1.0, 1.0, -1.0, -1.0]
    assert [row["prepared_V1"] for row in rows] == [10.0, 20.0, 30.0, 20.0]
    assert rows[2]["Time"] is None


def test_class_weight(spark):
    row = prep.class_weight(labelled(spark, 100, 10)).first()
    assert tuple(row) == (90, 10, 9.0)
    assert prep.class_weight(labelled(spark, 100, 10).where("Class = 0")).first()["scale_pos_weight"] is None
