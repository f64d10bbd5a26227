"""Where intermediate tables go."""

import pytest

from txnscore import workspace


class Conf(dict):
    def set(self, name, value):
        self[name] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({name.replace("__", "."): value for name, value in conf.items()})


def test_the_named_folder_is_used():
    session = Session(spark__master="yarn", spark__checkpoint__dir="hdfs://shared/work/")
    assert workspace.shared_root(session) == "hdfs://shared/work"
    assert workspace.new_folder(session, "x").startswith("hdfs://shared/work/x-")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError):
        workspace.shared_root(Session(spark__master="spark://host:7077"))


def test_a_local_master_gets_one_temporary_folder():
    session = Session(spark__master="local[2]")
    assert workspace.shared_root(session) == workspace.shared_root(session)


def test_folders_differ(spark):
    assert workspace.new_folder(spark, "a") != workspace.new_folder(spark, "a")


def test_written_rows_are_the_same(spark):
    df = spark.range(10).selectExpr("id", "id / 4 AS part")
    back = workspace.written(df, "rows")
    assert back.columns == df.columns and back.exceptAll(df).count() == 0 and back.count() == 10


def test_only_narrow_scans_are_spread(spark):
    assert workspace.spread(spark.range(0, 100, 1, 2)).rdd.getNumPartitions() == 8
    for partitions in (4, 8, 16):
        scan = spark.range(0, 100, 1, partitions)
        assert workspace.spread(scan) is scan
