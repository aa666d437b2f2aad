"""The topic as a log of segment files, read by a streaming source with
offsets per partition.

A log is a folder ``partition=<p>/segment=<base offset>/`` of Parquet files
with the topic's rows; a segment never changes once its file is there.  The
source keeps one next-offset per partition, so a restarted query goes on from
the offsets in its checkpoint, and each segment a batch overlaps is one Spark
partition, read as Arrow batches of the rows inside the batch's offsets.

Options (all but ``path`` optional):

``path``, ``topic``       the log, and the topic whose rows are kept
``maxOffsetsPerTrigger``  at most this many offsets a batch, dealt over the
                          partitions in proportion to what each has pending
``minOffsetsPerTrigger``, ``minBytesPerTrigger``, ``maxTriggerDelay``
                          a batch is cut when this many offsets or bytes are
                          pending, or when rows have waited this many seconds
``checkpoint``            the query's checkpoint folder, needed by the limits:
                          a restarted source reads its position there

Offsets may have gaps.  An empty log is a stream without rows; a partition or
segment that appears later is picked up; a segment deleted after a batch was
planned on it stops the query.  With ``availableNow`` a limited source takes
one batch.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOPIC_SCHEMA = ("key string, value string, topic string, partition int, offset bigint,"
                " timestamp timestamp")
ARROW_SCHEMA = pa.schema([("key", pa.string()), ("value", pa.string()), ("topic", pa.string()),
                          ("partition", pa.int32()), ("offset", pa.int64()),
                          ("timestamp", pa.timestamp("us", tz="UTC"))])
# Folder columns of a log; the partition is stored in the rows as well.
LOG_PARTS = ("log_partition", "segment")
BATCH_ROWS = 8192


@dataclass(frozen=True)
class Segment:
    partition: int
    base: int
    path: str
    size: int


@dataclass
class SegmentRange(InputPartition):
    """The offsets from ``low`` up to but without ``high`` of one segment file."""

    path: str
    low: int
    high: int


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, with or without a scheme, and its path there."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def list_segments(path: str) -> list[Segment]:
    """Every segment file, by partition and base offset."""
    fs, root = filesystem(path)
    found = []
    for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True)):
        folders = dict(p.split("=", 1) for p in f.path.split("/") if "=" in p)
        if f.type == pafs.FileType.File and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")) \
                and "_temporary" not in f.path and all(name in folders for name in LOG_PARTS):
            found.append(Segment(int(folders["log_partition"]), int(folders["segment"]), f.path, f.size))
    return sorted(found, key=lambda s: (s.partition, s.base, s.path))


def end_offset(fs: pafs.FileSystem, path: str) -> int:
    """One past a segment file's largest offset, from its footer's statistics."""
    with fs.open_input_file(path) as f:
        meta = pq.ParquetFile(f).metadata
        col = meta.schema.names.index("offset")
        return 1 + max(meta.row_group(i).column(col).statistics.max for i in range(meta.num_row_groups))


def last_planned(checkpoint: str) -> dict | None:
    """The offsets of the newest batch in a checkpoint's offset log, of the
    query's first source (None: no batch yet)."""
    fs, root = filesystem(checkpoint)
    logs = [f for f in fs.get_file_info(pafs.FileSelector(f"{root}/offsets", allow_not_found=True)) if f.base_name.isdigit()]
    if not logs:
        return None
    with fs.open_input_stream(max(logs, key=lambda f: int(f.base_name)).path) as f:
        lines = f.read().decode().splitlines()
    return None if lines[2] == "-" else json.loads(lines[2])


def deal(pending: dict[str, int], limit: int) -> dict[str, int]:
    """``limit`` offsets dealt over partitions in proportion to what is
    pending, the remainder in order; each partition gets at most its own."""
    total = sum(pending.values())
    if total <= limit:
        return dict(pending)
    shares = {p: n * limit // total for p, n in pending.items()}
    for p in sorted(pending):
        if sum(shares.values()) < limit and shares[p] < pending[p]:
            shares[p] += 1
    return shares


class SegmentReader(DataSourceStreamReader):
    """Offsets are ``{"<partition>": next offset}``."""

    def __init__(self, options):
        self.path, self.topic, self.checkpoint = options["path"], options.get("topic"), options.get("checkpoint")
        self.most = int(options.get("maxOffsetsPerTrigger", 0))
        self.least = int(options.get("minOffsetsPerTrigger", 0))
        self.least_bytes = int(options.get("minBytesPerTrigger", 0))
        self.delay = float(options.get("maxTriggerDelay", 0))
        if (self.most or self.least or self.least_bytes) and not self.checkpoint:
            raise ValueError("a limited segment source needs the option checkpoint")
        self.position: dict | None = None
        self.waiting_since: float | None = None
        self.ends: dict[str, int] = {}      # of files whose footer was read

    def initialOffset(self) -> dict:
        return {}

    def _end(self, fs, segment: Segment) -> int:
        if segment.path not in self.ends:
            self.ends[segment.path] = end_offset(fs, segment.path)
        return self.ends[segment.path]

    def latestOffset(self) -> dict:
        fs, _ = filesystem(self.path)
        segments = list_segments(self.path)
        available, first = {}, {}
        newest = {s.partition: s.base for s in segments}
        for s in segments:
            first.setdefault(str(s.partition), s.base)
            if s.base == newest[s.partition]:
                available[str(s.partition)] = max(available.get(str(s.partition), 0), self._end(fs, s))
        if not self.checkpoint:
            return available
        if self.position is None:
            self.position = last_planned(self.checkpoint) or {}
        start = {p: max(self.position.get(p, 0), first[p]) for p in available}
        pending = {p: max(0, available[p] - start[p]) for p in available}
        if not any(pending.values()) or not self._due(pending, segments, start):
            return dict(self.position)
        taken = deal(pending, self.most) if self.most else pending
        self.position = {**self.position, **{p: start[p] + n for p, n in taken.items()}}
        self.waiting_since = None
        return dict(self.position)

    def _due(self, pending: dict, segments: list[Segment], start: dict) -> bool:
        """The flush rule: enough offsets, enough bytes, or rows that waited."""
        if not (self.least or self.least_bytes):
            return True
        now = time.monotonic()
        self.waiting_since = now if self.waiting_since is None else self.waiting_since
        new_bytes = sum(s.size for s in segments if s.base >= start[str(s.partition)])
        return bool((self.least and sum(pending.values()) >= self.least)
                    or (self.least_bytes and new_bytes >= self.least_bytes)
                    or now - self.waiting_since >= self.delay)

    def partitions(self, start: dict, end: dict) -> list[SegmentRange]:
        segments, ranges = list_segments(self.path), []
        bases: dict[int, list[int]] = {}
        for s in segments:
            bases.setdefault(s.partition, []).append(s.base)
        for s in segments:
            p = str(s.partition)
            after = min((b for b in bases[s.partition] if b > s.base), default=None)
            low, high = start.get(p, 0), end.get(p, 0)
            if s.base < high and low < high and (after is None or after > low):
                ranges.append(SegmentRange(s.path, low, high))
        return ranges

    def read(self, partition: SegmentRange) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        wanted = (ds.field("offset") >= partition.low) & (ds.field("offset") < partition.high)
        if self.topic:
            wanted &= ds.field("topic") == self.topic
        file = ds.dataset(partition.path, filesystem=fs, format="parquet")
        for batch in file.to_batches(columns=ARROW_SCHEMA.names, filter=wanted, batch_size=BATCH_ROWS, use_threads=False):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in ARROW_SCHEMA], schema=ARROW_SCHEMA)

    def commit(self, end: dict) -> None:
        """Segments are kept or deleted by whoever writes the log."""


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_segments"

    def schema(self) -> str:
        return TOPIC_SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)


def write_segments(rows: DataFrame, path: str, segment_offsets: int) -> None:
    """Append topic rows to a log, in segments of ``segment_offsets`` offsets:
    one file each, sorted by offset.  Segments of one call must be new."""
    size = int(segment_offsets)
    (rows.withColumn("log_partition", F.col("partition"))
     .withColumn("segment", F.expr(f"offset div {size} * {size}"))
     .repartition(*LOG_PARTS).sortWithinPartitions(*LOG_PARTS, "offset")
     .write.mode("append").partitionBy(*LOG_PARTS).parquet(path))


def read_segments_stream(spark: SparkSession, path: str, topic: str, **options) -> DataFrame:
    """The log as a stream of topic rows (options above)."""
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format(SegmentSource.name()).option("path", path).option("topic", topic)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()
