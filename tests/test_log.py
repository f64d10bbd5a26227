"""The record log: what readers see, how much a batch takes, and what happens to lost records."""

import glob
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException

from frames import message, record, records
from txnscore.jobs import LOG_PARTITIONS, extend_log
from txnscore.sources.log import (
    EARLIEST,
    LATEST,
    LogRange,
    RecordLogReader,
    Segment,
    advanced,
    append_to_log,
    bounds,
    log_stream,
    retire,
    shares,
    unread_from,
)
from txnscore.streaming.scoring import work_off
from txnscore.workspace import new_folder


def add(spark, path, *places, size=1_000):
    rows = [record(offset, message(offset), partition, offset) for partition, offset in places]
    append_to_log(records(spark, rows), path, size)


def read(spark, path, checkpoint, **options):
    """The (partition, offset) pairs of each batch, worked off to the end."""
    batches = []

    def keep(batch, _):
        batches.append(sorted((row["partition"], row["offset"]) for row in batch.collect()))

    stream = log_stream(spark, path, **options).writeStream.foreachBatch(keep)
    work_off(stream.option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start())
    return batches


@given(st.dictionaries(st.integers(0, 9), st.integers(0, 50)), st.integers(1, 200))
def test_shares_are_within_the_limit_and_use_it(unread, limit):
    given_out = shares(unread, limit)
    assert sum(given_out.values()) == min(limit, sum(unread.values()))
    assert all(0 <= given_out[partition] <= unread[partition] for partition in unread)


@settings(max_examples=200)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 6)), max_size=6), st.integers(0, 40), st.data())
def test_an_advance_passes_as_many_offsets_as_it_says(spans, start, data):
    segments, at = [], 0
    for gap, length in spans:
        segments.append(Segment(f"{at}", 0, at + gap, at + gap + length))
        at += gap + length
    ahead = [offset for one in segments for offset in range(one.first, one.end) if offset >= start]
    assert unread_from(segments, start) == len(ahead)
    count = data.draw(st.integers(0, len(ahead)))
    end = advanced(segments, start, count)
    assert sum(offset < end for offset in ahead) == count


def test_segments_hold_one_partition_and_so_many_records(spark):
    path = f"{new_folder(spark, 'log')}/log"
    add(spark, path, *[(p, offset) for p in (0, 1) for offset in range(10)], size=4)
    assert bounds(path) == {0: (0, 10), 1: (0, 10)} == bounds(f"file://{path}")
    assert len(glob.glob(f"{path}/*/*/*.parquet")) == 6
    assert retire(path, {0: 8}) == 2 and bounds(path) == {0: (8, 10), 1: (0, 10)}


def test_an_unfinished_append_is_not_seen(spark):
    path = f"{new_folder(spark, 'log')}/log"
    assert bounds(path) == {}
    add(spark, path, (0, 0), (0, 1))
    add(spark, path, (0, 2))
    before = bounds(path)
    os.remove(max(glob.glob(f"{path}/*/_SUCCESS"), key=os.path.getmtime))
    assert before == {0: (0, 3)} and bounds(path) == {0: (0, 2)}


def test_batches_are_limited_and_go_on_after_a_restart(spark):
    root = new_folder(spark, "log")
    add(spark, f"{root}/log", *[(0, offset) for offset in range(8)], *[(1, offset) for offset in range(2)], size=3)
    first = read(spark, f"{root}/log", f"{root}/at", starting_offsets=EARLIEST, max_offsets_per_trigger=5)
    assert [len(batch) for batch in first] == [5, 5] and {p for p, _ in first[0]} == {0, 1}
    assert sorted(sum(first, [])) == [(0, offset) for offset in range(8)] + [(1, 0), (1, 1)]
    # A gap of any length takes no batches, and a new partition is read from its first record.
    add(spark, f"{root}/log", (0, 10**12), (2, 7))
    again = read(spark, f"{root}/log", f"{root}/at", starting_offsets=LATEST, max_offsets_per_trigger=5)
    assert sum(again, []) == [(0, 10**12), (2, 7)]


def test_a_task_reads_a_segment_in_small_batches(spark):
    """A task must not hold more of a long segment than of a short one."""
    path = f"{new_folder(spark, 'log')}/log"
    numbered = spark.range(10_000).selectExpr(
        "CAST(CAST(id AS STRING) AS BINARY) AS key", "CAST(repeat(CAST(id AS STRING), 200) AS BINARY) AS value",
        "'raw_transactions' AS topic", "0 AS partition", "id AS offset", "timestamp'2024-01-01' AS timestamp",
    )
    append_to_log(numbered.coalesce(1), path)
    [segment] = glob.glob(f"{path}/*/*/*.parquet")
    batches = list(RecordLogReader({"path": path}).read(LogRange(segment, 7, 9_990)))
    assert [offset for batch in batches for offset in batch.column("offset").to_pylist()] == list(range(7, 9_990))
    assert max(batch.nbytes for batch in batches) < 4 << 20


def test_latest_start_reads_what_comes_later(spark):
    root = new_folder(spark, "log")
    add(spark, f"{root}/log", (0, 0), (0, 1))
    assert sum(read(spark, f"{root}/log", f"{root}/at"), []) == []
    add(spark, f"{root}/log", (0, 2))
    assert sum(read(spark, f"{root}/log", f"{root}/at"), []) == [(0, 2)]


def test_lost_records_stop_the_query_unless_it_bears_them(spark):
    root = new_folder(spark, "log")
    add(spark, f"{root}/log", (0, 0), (0, 1))
    assert sum(read(spark, f"{root}/log", f"{root}/at", starting_offsets=EARLIEST), []) == [(0, 0), (0, 1)]
    add(spark, f"{root}/log", (0, 2), (0, 3))
    add(spark, f"{root}/log", (0, 4))
    assert retire(f"{root}/log", {0: 4}) == 2
    with pytest.raises(StreamingQueryException, match="LostRecordsError"):
        read(spark, f"{root}/log", f"{root}/at")
    assert sum(read(spark, f"{root}/log", f"{root}/at", fail_on_data_loss=False), []) == [(0, 4)]


def test_a_log_that_ends_before_the_query_is_lost(spark):
    path = f"{new_folder(spark, 'log')}/log"
    add(spark, path, (0, 0), (0, 1))
    reader = RecordLogReader({"path": path, "failOnDataLoss": "true"})
    reader.position = {"0": 9}
    with pytest.raises(RuntimeError, match="the query is at 9"):
        reader.latestOffset()
    tolerant = RecordLogReader({"path": path, "failOnDataLoss": "false"})
    tolerant.position = {"0": 9}
    assert tolerant.latestOffset() == {"0": 2}
    assert [(one.first, one.end) for one in tolerant.partitions({"0": 0}, {"0": 2})] == [(0, 2)]


@pytest.mark.parametrize("options", [{"startingOffsets": "first"}, {"maxOffsetsPerTrigger": "0"}])
def test_options_that_make_no_sense(spark, options):
    with pytest.raises(ValueError):
        RecordLogReader({"path": "/none", **options})


def test_the_producer_adds_behind_what_is_there(spark):
    path = f"{new_folder(spark, 'log')}/log"
    keyed = spark.range(1, 13).selectExpr(
        "CAST(CAST(id AS STRING) AS BINARY) AS key", "CAST(CAST(id AS STRING) AS BINARY) AS value", "id AS number", "current_timestamp() AS now"
    )
    extend_log(keyed, path)
    once = bounds(path)
    extend_log(keyed, path)
    twice = bounds(path)
    assert set(once) == set(twice) == set(range(LOG_PARTITIONS))
    assert all(twice[p][0] == once[p][0] and twice[p][1] > max(end for _, end in once.values()) for p in once)
