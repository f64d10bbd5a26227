"""A log of Kafka-shaped records in files, read as a stream by partition and offset.

Each append writes a folder of segments: Parquet files that hold records of one partition, sorted by offset. Readers see a
folder as soon as its ``_SUCCESS`` is there, so an append shows whole or not at all. The range of a segment stands in
its footer, which the driver reads once; tasks read the rows. As in Kafka, offsets grow within a partition and may have gaps,
a batch takes at most so many offsets, shared among the partitions by what each has unread (gaps between segments do not
count), and a query goes on where its
checkpoint stands.

Records are lost when a partition has files, but the oldest begins behind the position of the query, or the newest ends
before it. That stops the query, or with ``failOnDataLoss`` off the query goes on with the oldest record there is. The
folder may be a local path or any address that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import posixpath
import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from txnscore.config import MAX_OFFSETS_PER_TRIGGER
from txnscore.schemas import KAFKA_RECORD

RECORDS_PER_SEGMENT = 1_000_000
# A task that reads a segment holds some batches of this many records and a buffer of this many bytes per column.
_BATCH_RECORDS, _BUFFER_BYTES = 2_048, 1 << 20
EARLIEST, LATEST = "earliest", "latest"

_ARROW = pa.schema(
    {
        "key": pa.binary(),
        "value": pa.binary(),
        "topic": pa.string(),
        "partition": pa.int32(),
        "offset": pa.int64(),
        "timestamp": pa.timestamp("us", "UTC"),
    }
)


class LostRecordsError(RuntimeError):
    """Records that the query has not read are gone."""


class Segment(NamedTuple):
    """A file of records of one partition, from offset ``first`` to before ``end``."""

    path: str
    partition: int
    first: int
    end: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _range_of(files: fs.FileSystem, path: str) -> Segment | None:
    """The segment in a file by its footer; None if it has no rows."""
    with files.open_input_file(path) as opened:
        facts = pq.ParquetFile(opened).metadata
    spans = {"partition": [], "offset": []}
    for group in range(facts.num_row_groups):
        for place in range(facts.num_columns):
            column = facts.row_group(group).column(place)
            if column.path_in_schema in spans:
                spans[column.path_in_schema] += [column.statistics.min, column.statistics.max]
    if not facts.num_rows:
        return None
    if len(set(spans["partition"])) != 1:
        raise ValueError(f"{path} holds records of more than one partition")
    return Segment(path, spans["partition"][0], min(spans["offset"]), max(spans["offset"]) + 1)


class SegmentIndex:
    """The segments of a log; a footer is read once."""

    def __init__(self, path: str) -> None:
        self.files, self.root = _opened(path)
        self._known: dict[str, Segment | None] = {}

    def segments(self) -> dict[int, list[Segment]]:
        """By partition, in the order of offsets."""
        listed = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True, recursive=True))
        paths = [info.path for info in listed if info.type == fs.FileType.File]
        whole = {posixpath.dirname(path) for path in paths if posixpath.basename(path) == "_SUCCESS"}
        # A segment lies in the folder of its partition, which lies in the folder of its append.
        there = [
            path
            for path in paths
            if path.endswith(".parquet") and posixpath.dirname(posixpath.dirname(path)) in whole
        ]
        self._known = {path: self._known[path] if path in self._known else _range_of(self.files, path) for path in there}
        found = defaultdict(list)
        for segment in filter(None, self._known.values()):
            found[segment.partition].append(segment)
        return {partition: sorted(some, key=lambda one: (one.first, one.path)) for partition, some in found.items()}


def bounds(path: str) -> dict[int, tuple[int, int]]:
    """Per partition, the first offset there is and the one after the last."""
    return {
        partition: (some[0].first, max(one.end for one in some))
        for partition, some in SegmentIndex(path).segments().items()
    }


def append_to_log(records: DataFrame, path: str, records_per_segment: int = RECORDS_PER_SEGMENT) -> None:
    """Adds Kafka-shaped records; their offsets must lie behind those that the log has in their partition."""
    placed = records.select(*KAFKA_RECORD.names, F.col("partition").alias("of_partition"))
    (
        placed.repartitionByRange("of_partition", "offset")
        .sortWithinPartitions("of_partition", "offset")
        .write.option("maxRecordsPerFile", records_per_segment)
        .partitionBy("of_partition")
        .parquet(f"{path.rstrip('/')}/append-{uuid.uuid4().hex}")
    )


def retire(path: str, before: dict[int, int]) -> int:
    """Removes the segments that end at or before an offset of their partition; how many there were."""
    index = SegmentIndex(path)
    old = [one for some in index.segments().values() for one in some if one.end <= before.get(one.partition, one.first)]
    for segment in old:
        index.files.delete_file(segment.path)
    return len(old)


def shares(unread: dict[int, int], limit: int) -> dict[int, int]:
    """What each partition gives to a batch of at most ``limit`` offsets, in proportion to what it has unread."""
    total = sum(unread.values())
    if total <= limit:
        return unread
    given = {partition: n * limit // total for partition, n in unread.items()}
    left = limit - sum(given.values())
    for partition in sorted(unread):
        more = min(left, unread[partition] - given[partition])
        given[partition] += more
        left -= more
    return given


def unread_from(segments: list[Segment], start: int) -> int:
    """Offsets of the segments from ``start`` on; gaps between segments do not count."""
    return sum(max(0, one.end - max(one.first, start)) for one in segments)


def advanced(segments: list[Segment], start: int, count: int) -> int:
    """The offset after the next ``count`` ones of the segments, whatever gaps lie between these."""
    for one in segments:
        low = max(one.first, start)
        if 0 < count <= one.end - low:
            return low + count
        if low < one.end:
            count -= min(count, one.end - low)
    return start


class LogRange(InputPartition):
    """The records of one segment that a task reads."""

    def __init__(self, path: str, first: int, end: int) -> None:
        self.path, self.first, self.end = path, first, end


class RecordLogReader(DataSourceStreamReader):
    """Offsets are the next one to read, by partition."""

    def __init__(self, options) -> None:
        self.path = options["path"]
        self.start = options.get("startingOffsets", LATEST)
        self.limit = int(options.get("maxOffsetsPerTrigger", MAX_OFFSETS_PER_TRIGGER))
        self.strict = options.get("failOnDataLoss", "true") == "true"
        if self.start not in (EARLIEST, LATEST) or self.limit < 1:
            raise ValueError("startingOffsets must be earliest or latest, maxOffsetsPerTrigger at least 1")
        self.index = SegmentIndex(self.path)
        self.position: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        ends = {
            str(partition): some[0].first if self.start == EARLIEST else max(one.end for one in some)
            for partition, some in self.index.segments().items()
        }
        self.position = self.position or ends
        return ends

    def latestOffset(self) -> dict:
        if self.position is None:
            self.initialOffset()
        segments = self.index.segments()
        froms = {partition: self._from(self.position, partition, some) for partition, some in segments.items()}
        taken = shares({p: unread_from(some, froms[p]) for p, some in segments.items()}, self.limit)
        self.position = self.position | {
            str(p): advanced(some, froms[p], taken[p]) for p, some in sorted(segments.items())
        }
        return self.position

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # A query that starts again asks for its last batch first, which tells where it stands.
        self.position = self.position or end
        ranges = []
        for partition, some in self.index.segments().items():
            upto = end.get(str(partition), 0)
            if start.get(str(partition), -1) >= upto:
                continue
            low = self._from(start, partition, some)
            ranges += [
                LogRange(one.path, max(low, one.first), min(upto, one.end))
                for one in some
                if max(low, one.first) < min(upto, one.end)
            ]
        return ranges

    def commit(self, end: dict) -> None:
        self.position = self.position or end

    def _from(self, position: dict, partition: int, some: list[Segment]) -> int:
        """Where to go on in a partition; a new one is read from its first record."""
        first, end = some[0].first, max(one.end for one in some)
        wanted = position.get(str(partition), first)
        if first <= wanted <= end:
            return wanted
        if self.strict:
            raise LostRecordsError(
                f"partition {partition} of {self.path} holds offsets {first} to {end - 1}, the query is at {wanted}"
            )
        return first

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        files, path = _opened(partition.path)
        with files.open_input_file(path) as opened:
            segment = pq.ParquetFile(
                opened, coerce_int96_timestamp_unit="us", pre_buffer=False, buffer_size=_BUFFER_BYTES
            )
            for batch in segment.iter_batches(_BATCH_RECORDS, columns=_ARROW.names, use_threads=False):
                offset = batch.column("offset")
                wanted = pc.and_(pc.greater_equal(offset, partition.first), pc.less(offset, partition.end))
                yield from _shaped(batch.filter(wanted)).to_batches()


def _shaped(batch: pa.RecordBatch) -> pa.Table:
    """The batch with the types of a record; times in files are in UTC, whether they say so or not."""
    table = pa.Table.from_batches([batch]).select(_ARROW.names)
    place = _ARROW.get_field_index("timestamp")
    if table.schema.field("timestamp").type.tz is None:
        table = table.set_column(place, "timestamp", pc.assume_timezone(table.column("timestamp"), "UTC"))
    return table.cast(_ARROW)


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> StructType:
        return KAFKA_RECORD

    def streamReader(self, schema: StructType) -> RecordLogReader:
        return RecordLogReader(self.options)


def log_stream(
    spark: SparkSession,
    path: str,
    starting_offsets: str = LATEST,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """A record log as a stream, with the options of a Kafka stream; ``starting_offsets`` counts for a new checkpoint."""
    spark.dataSource.register(RecordLog)
    options = {
        "path": path,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return spark.readStream.format(RecordLog.name()).options(**options).load()
