"""What a running job tells of itself: totals and lag of every batch, and the error that ends it.

The values come from the query's own progress, so they cost no job over the data: ``observed`` puts the
fetch totals into the plan of the stream, and ``JobMonitor`` gets them with the offsets of the sources
when a batch is done, and the exception when the query ends. Both leave A10 rows (``MONITOR``) and, per
batch and source partition, a row of the table that ``offset_lag`` and ``fetch_per_minute`` read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from rowtide.operators.monitoring import FETCH_MEASURES, MONITOR_IDS
from rowtide.schemas import MONITOR

#: Name of the observed fetch totals in a query's progress.
FETCHED = "fetched"
OFFSETS = (
    "src_topic string, src_partition int, fetch_ts timestamp, start_offset bigint, next_offset bigint, "
    "latest_offset bigint, n_bytes bigint"
)
LIVE = f"{MONITOR.simpleString()[len('struct<'):-1]}, batch_id bigint, at timestamp".replace(":", " ")


def observed(stream: DataFrame) -> DataFrame:
    """The stream with its messages and bytes counted as they pass."""
    size: Column = F.octet_length("value") if "value" in stream.columns else F.lit(0)
    return stream.observe(
        FETCHED, F.count("*").alias("n"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0).cast("bigint")).alias("size")
    )


def offsets_of(text: str | None) -> dict[tuple[str, int], int]:
    """Offsets by (topic, partition) of a source that tells them as ``{"topic": {"0": 5}}``; none for others."""
    try:
        document = json.loads(text or "null")
        return {(topic, int(p)): int(n) for topic, parts in document.items() for p, n in parts.items()}
    except (AttributeError, TypeError, ValueError):
        return {}


@dataclass(frozen=True)
class Fetched:
    """One batch: its totals and where each source partition stands."""

    batch_id: int
    at: str
    n: int
    size: int
    start: dict[tuple[str, int], int]
    end: dict[tuple[str, int], int]
    latest: dict[tuple[str, int], int]

    @property
    def lag(self) -> int:
        """Messages the sources hold beyond what was fetched, of all partitions."""
        return sum(max(0, n - self.end.get(source, 0)) for source, n in self.latest.items())


def fetched(progress, latest: Callable[[], dict[tuple[str, int], int]] | None = None) -> Fetched:
    """The batch that a query's progress tells of.

    ``latest`` asks sources that do not tell how far they have come, or tell the end of the batch.
    """
    total = progress.observedMetrics.get(FETCHED)
    start, end, last = {}, {}, {}
    for source in progress.sources:
        start |= offsets_of(source.startOffset)
        end |= offsets_of(source.endOffset)
        last |= offsets_of(source.latestOffset)
    n = progress.numInputRows if total is None else total["n"]
    size = 0 if total is None else total["size"]
    return Fetched(progress.batchId, progress.timestamp, n, size, start, end, latest() if latest else last or end)


class JobMonitor(StreamingQueryListener):
    """Writes the monitor rows of the queries of one name, a folder per run and batch.

    A repeated batch writes its folder anew, so it is not counted twice. Rows of ``EXCEPTION`` hold
    the message of the error that ended a query.
    """

    def __init__(
        self, spark: SparkSession, job: str, out: str,
        latest: Callable[[], dict[tuple[str, int], int]] | None = None,
    ):
        self._session, self.job, self.out, self.latest = spark, job, out, latest
        self._own: set[str] = set()

    def _write(self, rows: list[tuple], schema: str, table: str, query: str, name: str) -> None:
        frame = self._session.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.out}/{table}/run={query}/event={name}")

    def _live(self, kind: str, content: dict, batch_id: int | None, at: str) -> tuple:
        when = datetime.fromisoformat(at.replace("Z", "+00:00"))
        return MONITOR_IDS[kind], self.job, json.dumps(content, sort_keys=True, separators=(",", ":")), batch_id, when

    def onQueryStarted(self, event) -> None:
        if event.name == self.job:
            self._own.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.job:
            return
        batch = fetched(progress, self.latest)
        values = dict(zip(FETCH_MEASURES, (batch.n, batch.size, batch.lag), strict=True))
        row = self._live("FETCH", values, batch.batch_id, batch.at)
        self._write([row], LIVE, "live_monitor", str(progress.id), f"batch-{batch.batch_id}")
        places = [
            (topic, partition, row[-1], batch.start.get((topic, partition)), n, batch.latest.get((topic, partition), n), None)
            for (topic, partition), n in sorted(batch.end.items())
        ]
        if places:
            self._write(places, OFFSETS, "live_offsets", str(progress.id), f"batch-{batch.batch_id}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) not in self._own:
            return
        try:
            if event.exception:
                row = self._live("EXCEPTION", {"EXCEPTION": event.exception}, None, datetime.now(UTC).isoformat())
                self._write([row], LIVE, "live_monitor", str(event.id), f"end-{event.runId}")
        finally:
            self._own.discard(str(event.runId))

    def running(self) -> bool:
        """Whether a query of this job has begun and its end is not written yet."""
        return bool(self._own)


def live_rows(spark: SparkSession, out: str) -> DataFrame:
    """All rows that monitors have left in a folder."""
    return spark.read.schema(LIVE).parquet(f"{out}/live_monitor")


def live_offsets(spark: SparkSession, out: str) -> DataFrame:
    """Where the sources stood after every batch, as ``offset_lag`` takes it."""
    return spark.read.schema(OFFSETS).parquet(f"{out}/live_offsets")
