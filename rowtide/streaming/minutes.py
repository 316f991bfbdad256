"""Messages and bytes per source partition and minute of a stream, with a side table for late rows.

A source partition's watermark is the newest time it has shown less the allowed lateness. Minutes that end
after it are open and take rows; when it passes them they are written once to ``minutes`` and leave the
state. Rows whose minute the watermark had passed before their epoch began are counted to ``late``, so
nothing is dropped: minutes, late rows and what is still open add up to the batch count. The state is a
row per source partition and open minute: with a lateness of ten minutes twelve at most, however long the
stream runs and however far off a time lies.

Each epoch starts from the state of the epoch before and is published as a whole, so a replay counts
nothing twice. A new checkpoint folder starts with no state; what earlier runs left stays counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.files import file_system
from rowtide.operators.monitoring import fetch_per_minute
from rowtide.operators.ordering import SOURCE
from rowtide.sinks.commits import is_published, publish, published, read_committed

_COUNTS = ("fetch_num", "fetch_size")


@dataclass(frozen=True)
class MinuteCounts:
    """Where the counts of a stream of fetched messages (``fetch_ts``, ``n_bytes``, source) are kept."""

    out: str
    lateness: str = "10 minutes"

    def process(self, batch: DataFrame, epoch: int, run: str | None = None) -> None:
        """Count one micro-batch."""
        spark = batch.sparkSession
        run = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"
        if is_published(self.out, run, epoch):
            return
        topic = F.coalesce("src_topic", F.lit("")) if "src_topic" in batch.columns else F.lit("")
        counted = fetch_per_minute(batch.withColumn("src_topic", topic), newest=F.max("fetch_ts"))
        held = spark.read.parquet(self._state(run, epoch - 1)) if epoch > 0 else counted.limit(0)
        marks = held.groupBy(*SOURCE).agg(F.max("newest").alias("_mark"))
        # One row per source partition and minute of the batch; all outputs are made of these.
        counted = counted.join(marks, list(SOURCE), "left").withColumn("_late", self._passed("_mark")).persist()
        try:
            self._write(counted.where("_late").drop("newest", "_mark", "_late"), "late", run, epoch)
            known = counted.where("not _late").drop("_mark", "_late").unionByName(held)
            newest = known.groupBy(*SOURCE).agg(F.max("newest").alias("newest"))
            minutes = known.groupBy(*SOURCE, "minute").agg(*[F.sum(c).alias(c) for c in _COUNTS])
            now = minutes.join(newest, list(SOURCE)).withColumn("_closed", self._passed("newest"))
            self._write(now.where("_closed").drop("newest", "_closed"), "minutes", run, epoch)
            self._write(now.where("not _closed").drop("_closed"), "open", run, epoch)
            publish(self.out, run, epoch, ["late", "minutes", "open"])
        finally:
            counted.unpersist()
        # An epoch that is published is never run again, so only the newest state is read.
        files, path = file_system(self._state(run, epoch - 1))
        if epoch > 0 and files.get_file_info(path).type.name == "Directory":
            files.delete_dir(path)

    def _passed(self, newest: str):
        """Whether the watermark has passed the minute; null, no watermark yet, counts as no."""
        end = F.col("minute") + F.expr(f"interval 1 minute + interval {self.lateness}")
        return F.coalesce(end <= F.col(newest), F.lit(False))

    def _state(self, run: str, epoch: int) -> str:
        return f"{self.out}/open/run={run}/epoch={epoch}"

    def _write(self, rows: DataFrame, table: str, run: str, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.out}/{table}/run={run}/epoch={epoch}")

    def start(self, fetched: DataFrame, checkpoint: str, **trigger):
        """Start the query; ``trigger`` as for ``writeStream.trigger``."""
        writer = fetched.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def open_minutes(self, spark: SparkSession) -> DataFrame | None:
        """The state of each run after its last epoch; None before the first."""
        last = {run: epoch for run, epoch in published(self.out)}
        if not last:
            return None
        return spark.read.parquet(*[self._state(run, epoch) for run, epoch in last.items()])

    def counts(self, spark: SparkSession) -> DataFrame | None:
        """All that was counted so far, with ``late_num`` of ``fetch_num`` from the side table."""
        still = self.open_minutes(spark)
        if still is None:
            return None
        still = still.drop("newest")
        parts = [still.withColumn("late_num", F.lit(0).cast("bigint"))]
        for table, late in (("minutes", F.lit(0).cast("bigint")), ("late", F.col("fetch_num"))):
            rows = read_committed(spark, self.out, table, still.schema).drop("run", "epoch")
            parts.append(rows.withColumn("late_num", late))
        every = parts[0].unionByName(parts[1]).unionByName(parts[2])
        return every.groupBy(*SOURCE, "minute").agg(*[F.sum(c).alias(c) for c in (*_COUNTS, "late_num")])
