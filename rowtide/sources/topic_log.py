"""A change topic as a folder of segments, and a streaming source that reads it by offsets of its own.

A segment is a Parquet file of consecutive messages of one topic partition; its name tells the first
offset and the one after the last: ``<log>/<topic>/<partition>/<first>-<next>.parquet``. Retention is
deleting the oldest segments. Ranges are planned from names alone, no segment is opened for it.

``format("topic_log")`` with the options

* ``path``: the log;
* ``starting``: ``earliest``, ``latest``, or ``{"topic": {"0": offset}}``. An offset out of range goes
  to the end it is beyond: above the latest to the latest, below the earliest to the earliest.
  Partitions without one start at their earliest offset;
* ``max_rows``, ``max_bytes``: what a micro-batch reads at most, shared out by what each partition has
  waiting; each partition that has something moves by one message at least;
* ``checkpoint``: the query's checkpoint folder. A limited query needs it to go on where it was, as
  the engine does not tell a source of this kind where its last batch ended;
* ``split_rows``: offsets that one task reads at most.

The rows tell in ``latest_offset`` how far the partition had come when the batch was planned.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from rowtide.files import file_system, names_in, new_file, read_text

SEGMENT_ROWS = 65_536
SEGMENT_BYTES = 64 << 20
SPLIT_ROWS = 1_000_000
MESSAGE = "src_topic string, src_partition int, src_offset bigint, timestamp timestamp, value binary, latest_offset bigint"

_STORED = pa.schema([("src_offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("value", pa.binary())])
Source = tuple[str, int]
Offsets = dict[Source, int]


@dataclass(frozen=True)
class Segment:
    first: int
    next: int
    path: str
    size: int


def append_segments(messages: DataFrame, log: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Write messages (the source, src_offset, timestamp, value) as segments; a row per segment.

    Each stretch of ``segment_rows`` offsets is sorted and written by one task, so a hot partition is
    written by many. A repeated task or append of the same offsets gives the same names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows, held = None, [], 0

        def close() -> pa.RecordBatch:
            topic, partition, _ = own
            first, last = rows[0][0], rows[-1][0] + 1
            with new_file(f"{log}/{quote(topic, safe='')}/{partition}/{first:020d}-{last:020d}.parquet") as out:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _STORED.types, strict=True)]
                pq.write_table(pa.Table.from_arrays(columns, schema=_STORED), out, compression="zstd")
            made = {"src_topic": [topic], "src_partition": [partition], "first_offset": [first], "next_offset": [last], "messages": [len(rows)]}
            return pa.RecordBatch.from_pydict(made, schema=_MADE)

        for batch in batches:
            for topic, partition, chunk, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and ((topic, partition, chunk) != own or held >= SEGMENT_BYTES):
                    yield close()
                    rows, held = [], 0
                own = (topic, partition, chunk)
                rows.append(row)
                held += len(row[2] or b"")
        if rows:
            yield close()

    key = ["src_topic", "src_partition", "_chunk"]
    placed = messages.select(
        F.coalesce("src_topic", F.lit("")).alias("src_topic"), F.col("src_partition").cast("int").alias("src_partition"),
        F.floor(F.col("src_offset") / F.lit(segment_rows)).cast("bigint").alias("_chunk"), F.col("src_offset").cast("bigint").alias("src_offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"), F.col("value").cast("binary").alias("value"),
    )
    placed = placed.repartition(*key).sortWithinPartitions(*key, "src_offset")
    return placed.mapInArrow(write, "src_topic string, src_partition int, first_offset bigint, next_offset bigint, messages bigint")


_MADE = pa.schema(
    [("src_topic", pa.string()), ("src_partition", pa.int32()), ("first_offset", pa.int64()), ("next_offset", pa.int64()), ("messages", pa.int64())]
)


def segments(log: str) -> dict[Source, list[Segment]]:
    """The segments of every topic partition, in the order of their offsets."""
    found: dict[Source, list[Segment]] = {}
    for topic in names_in(log):
        for partition in names_in(f"{log}/{topic}"):
            files, path = file_system(f"{log}/{topic}/{partition}")
            own = []
            for info in files.get_file_info(pafs.FileSelector(path)):
                name, dot, kind = info.base_name.partition(".")
                if name and kind == "parquet":
                    first, _, last = name.partition("-")
                    own.append(Segment(int(first), int(last), f"{log}/{topic}/{partition}/{info.base_name}", info.size))
            if own:
                found[unquote(topic), int(partition)] = sorted(own, key=lambda s: (s.first, s.next))
    return found


def latest_offsets(found: dict[Source, list[Segment]]) -> Offsets:
    return {source: max(s.next for s in own) for source, own in found.items()}


def offsets_from(document: dict) -> Offsets:
    return {(topic, int(p)): int(n) for topic, parts in document.items() for p, n in parts.items()}


def as_document(offsets: Offsets) -> dict:
    document: dict[str, dict[str, int]] = {}
    for (topic, partition), n in sorted(offsets.items()):
        document.setdefault(topic, {})[str(partition)] = n
    return document


def clamped(found: dict[Source, list[Segment]], wanted: Offsets) -> Offsets:
    """Where each partition goes on: see ``starting`` above."""
    latest = latest_offsets(found)
    return {s: min(max(wanted.get(s, own[0].first), own[0].first), latest[s]) for s, own in found.items()}


def limited(found: dict[Source, list[Segment]], start: Offsets, rows: int | None, size: int | None) -> Offsets:
    """Where a batch from ``start`` ends if it may read so many rows and bytes."""
    end = latest_offsets(found)
    at = clamped(found, start)
    waiting = {s: end[s] - at[s] for s in end}
    total = sum(waiting.values())
    if rows is not None and total > rows:
        end = {s: min(end[s], at[s] + max(1, rows * n // total)) if n else at[s] for s, n in waiting.items()}
    if size is None:
        return end

    def heavy(source: Source, last: int) -> Iterator[tuple[int, int, float]]:
        """Offsets that the segments have before ``last``, and the bytes of each of them."""
        for s in found[source]:
            low, high = max(s.first, at[source]), min(s.next, last)
            if low < high:
                yield low, high, s.size / (s.next - s.first)

    waiting = {s: sum((b - a) * each for a, b, each in heavy(s, n)) for s, n in end.items()}
    total = sum(waiting.values())
    if total <= size:
        return end
    for source, last in end.items():
        left = size * waiting[source] / total
        reached = at[source]
        for low, high, each in heavy(source, last):
            reached = min(high, low + int(left / each)) if each else high
            left -= (reached - low) * each
            if reached < high:
                break
        end[source] = max(reached, min(last, at[source] + 1))
    return end


class OffsetRange(InputPartition):
    """Offsets [first, next) of a topic partition and the segments that hold them."""

    def __init__(self, source: Source, first: int, last: int, latest: int, paths: list[str]):
        self.source, self.first, self.next, self.latest, self.paths = source, first, last, latest, paths


def ranges(found: dict[Source, list[Segment]], start: Offsets, end: Offsets, split_rows: int) -> list[OffsetRange]:
    """Tasks of a batch: cut at segments, and several small ones together up to ``split_rows``."""
    out, at, latest = [], clamped(found, start), latest_offsets(found)
    for source, last in sorted(end.items()):
        if source not in found:
            continue
        first = low = at[source]
        paths: list[str] = []
        for s in found[source]:
            if s.next <= at[source] or s.first >= last:
                continue
            if paths and s.next - low > split_rows:
                out.append(OffsetRange(source, low, s.first, latest[source], paths))
                low, paths = s.first, []
            paths.append(s.path)
        if paths and first < last:
            out.append(OffsetRange(source, low, last, latest[source], paths))
    return out


def _read(part: OffsetRange) -> Iterator[pa.RecordBatch]:
    topic, partition = part.source
    for path in part.paths:
        files, at = file_system(path)
        with files.open_input_file(at) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=4096):
                offset = batch.column(0)
                inside = pc.and_(pc.greater_equal(offset, part.first), pc.less(offset, part.next))
                batch = batch.filter(inside)
                n = batch.num_rows
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([topic] * n), pa.array([partition] * n, pa.int32()), *batch.columns,
                            pa.array([part.latest] * n, pa.int64()),
                        ],
                        names=["src_topic", "src_partition", "src_offset", "timestamp", "value", "latest_offset"],
                    )


class _Options:
    def __init__(self, options: dict[str, str]):
        # Spark hands options to a source with names in any case.
        own = {k.lower(): v for k, v in options.items()}
        self.log = own["path"].rstrip("/")
        self.starting = own.get("starting", "earliest")
        self.rows = int(own["max_rows"]) if "max_rows" in own else None
        self.bytes = int(own["max_bytes"]) if "max_bytes" in own else None
        self.checkpoint = own.get("checkpoint")
        self.split_rows = int(own.get("split_rows", SPLIT_ROWS))

    def first(self, found: dict[Source, list[Segment]]) -> Offsets:
        if self.starting == "latest":
            return latest_offsets(found)
        return clamped(found, {} if self.starting == "earliest" else offsets_from(json.loads(self.starting)))


class _Stream(DataSourceStreamReader):
    def __init__(self, options: _Options):
        self.options = options
        self.planned: Offsets | None = None

    def initialOffset(self) -> dict:
        return as_document(self.options.first(segments(self.options.log)))

    def latestOffset(self) -> dict:
        found = segments(self.options.log)
        if self.options.rows is None and self.options.bytes is None:
            return as_document(latest_offsets(found))
        if self.planned is None:
            stored = planned_offsets(self.options.checkpoint) if self.options.checkpoint else None
            self.planned = self.options.first(found) if stored is None else stored
        self.planned = limited(found, self.planned, self.options.rows, self.options.bytes)
        return as_document(self.planned)

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        return ranges(segments(self.options.log), offsets_from(start), offsets_from(end), self.options.split_rows)

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _Batch(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[OffsetRange]:
        found = segments(self.options.log)
        return ranges(found, self.options.first(found), latest_offsets(found), self.options.split_rows)

    def read(self, partition: OffsetRange | None) -> Iterator[pa.RecordBatch]:
        return _read(partition) if partition is not None else iter(())


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return MESSAGE

    def streamReader(self, schema) -> _Stream:
        return _Stream(_Options(self.options))

    def reader(self, schema) -> _Batch:
        return _Batch(_Options(self.options))


def planned_offsets(checkpoint: str) -> Offsets | None:
    """End of the newest batch that a query with this checkpoint folder has planned; None before the first."""
    batches = [int(n) for n in names_in(f"{checkpoint}/offsets") if n.isdigit()]
    if not batches:
        return None
    lines = read_text(f"{checkpoint}/offsets/{max(batches)}").splitlines()
    return offsets_from(json.loads(lines[2]))


def read_log(spark: SparkSession, log: str, streaming: bool = True, **options: str | int) -> DataFrame:
    """Messages of the log, see above for the options."""
    spark.dataSource.register(TopicLogSource)
    reader = spark.readStream if streaming else spark.read
    return reader.format("topic_log").options(path=log, **options).load()
