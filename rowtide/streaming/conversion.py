"""The conversion as a streaming query.

Each micro-batch runs the batch operators with the values at the last position, writes its
outputs under its run and epoch, the position row last, and then publishes the epoch. An epoch that
was not published starts again from the same position and overwrites its own outputs; one that was
is left as it is. So readers of published epochs see every record once and never half an epoch; a
topic may see a record again, as with any restart.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import monitoring as M
from rowtide.operators.ordering import SOURCE, is_end
from rowtide.operators.records import with_key
from rowtide.operators.routing import Routes, current_topics, ddl_log
from rowtide.options import ConvertOptions
from rowtide.plans.convert import numbered_images, records_of
from rowtide.schemas import POSITIONS
from rowtide.session import prepare_session
from rowtide.sinks.commits import is_published, publish
from rowtide.sinks.routes import RouteLog
from rowtide.sinks.tables import read_positions_before, write_by_topic
from rowtide.sources.tables import from_positions
from rowtide.sources.wire import DECODE_ERROR, decode_envelopes, decoded_ok, undecodable
from rowtide.streaming.monitor import observed


@dataclass(frozen=True)
class ConversionJob:
    """Where a conversion reads its routes and leaves its outputs.

    ``out`` is a folder on storage all executors share. ``clock`` gives the time of an epoch in
    milliseconds; tests pass a fixed one. ``timer`` measures how long a flush takes to be written.
    ``strict`` fails the job on bytes that do not decode; else they go to a quarantine table.
    ``routes`` may be a function that reads the routes as they are now: each epoch asks it, and what
    changed is kept in ``route_log`` as a version from the epoch's positions on.

    Outputs lie under the run and the epoch that made them. A run is the life of one checkpoint
    folder: with a new one the epochs start at 0 again, the job goes on from its own positions,
    and what earlier runs wrote stays as it is.
    """

    job: str
    routes: Routes | Callable[[], DataFrame]
    out: str
    clock: Callable[[int], int]
    options: ConvertOptions = field(
        default_factory=lambda: ConvertOptions(on_missing_key="quarantine")
    )
    initial: DataFrame | None = None
    strict: bool = False
    timer: Callable[[], float] = time.time

    def path(self, table: str, epoch: int | None = None, run: str = "0") -> str:
        base = f"{self.out}/{table}"
        return base if epoch is None else f"{base}/run={run}/epoch={epoch}"

    def starts(self, spark: SparkSession, epoch: int, run: str = "0") -> DataFrame | None:
        """Position rows to start this epoch from."""
        found = read_positions_before(spark, self.out, run, epoch)
        return self.initial if found is None else found

    def process(self, batch: DataFrame, epoch: int, run: str | None = None) -> None:
        """Convert one micro-batch of envelopes, or of messages with their bytes in ``value``."""
        spark = prepare_session(batch.sparkSession)
        # Spark gives each checkpoint folder an id and tells it to the batches it runs.
        run = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"
        if is_published(self.out, run, epoch):
            return  # a replay: what the epoch wrote is there and may be read by now
        now = int(self.clock(epoch))
        starts = self.starts(spark, epoch, run)
        step = self._next_step(starts)
        if starts is not None:
            batch = from_positions(batch, starts)
        fetched = batch
        bad = None
        if "value" in batch.columns:
            decoded = decode_envelopes(batch.withColumn("_bytes", F.octet_length("value")), strict=self.strict).persist()
            bad, fetched = undecodable(decoded), decoded
            batch = decoded_ok(decoded).drop("_bytes")
        # The ordered steps read the batch several times and every output needs the numbered
        # envelopes; both are kept, so that the source is read and converted once.
        batch = batch.persist()
        routes = self._routes_at(spark, starts)
        numbered = numbered_images(batch, routes, self.options, starts).persist()
        sent = None
        try:
            began = self.timer()
            totals = Observation()
            records = M.observed_sends(records_of(numbered, now, self.options), totals)
            write_by_topic(records, self.path("records", epoch, run), "overwrite")
            took = int((self.timer() - began) * 1000)
            # Totals were taken on the way out; rows per topic and source are counted over what was
            # written, for which the files' key and place are enough.
            sent = with_key(self._written(spark, records, epoch, run)).groupBy("topic", *SOURCE)
            sent = sent.agg(F.count("*").alias("sent")).persist()
            self._write(ddl_log(numbered), "ddl", epoch, run)
            if bad is not None:
                self._write(bad, "undecodable", epoch, run)
            monitor = self._monitor(numbered, current_topics(routes), sent, totals.get, fetched, bad, now, took)
            self._write(M.monitor_message(monitor), "monitor", epoch, run)
            sent_rows = sent.groupBy(*SOURCE).agg(F.sum("sent").alias("sent"))
            positions = next_positions(fetched, numbered, starts).join(sent_rows, list(SOURCE), "left")
            made = {"job": F.lit(self.job), "step": F.lit(step).cast("bigint"), "written_at": F.lit(now).cast("bigint")}
            made["sent"] = F.coalesce("sent", F.lit(0).cast("bigint"))
            self._write(
                positions.select(*[made.get(c, F.col(c)).alias(c) for c in POSITIONS.names]), "positions", epoch, run
            )
            tables = ("records", "ddl", "monitor", "positions", *(("undecodable",) if bad is not None else ()))
            publish(self.out, run, epoch, tables)
        finally:
            if sent is not None:
                sent.unpersist()
            numbered.unpersist()
            batch.unpersist()
            if bad is not None:
                decoded.unpersist()

    def _routes_at(self, spark: SparkSession, starts: DataFrame | None) -> Routes:
        if not callable(self.routes):
            return self.routes
        log = RouteLog(self.path("route_log"))
        log.note(self.routes(), starts)
        return log.read(spark)

    @staticmethod
    def _next_step(starts: DataFrame | None) -> int:
        if starts is None or "step" not in starts.columns:
            return 0
        last = starts.agg(F.max("step")).first()[0]
        return 0 if last is None else last + 1

    def _written(self, spark: SparkSession, records: DataFrame, epoch: int, run: str) -> DataFrame:
        # The schema is given, so an epoch without records reads as an empty table.
        schema = records.withColumn("status", F.lit("")).schema
        return spark.read.schema(schema).parquet(self.path("records", epoch, run))

    def _write(self, df: DataFrame, table: str, epoch: int, run: str) -> None:
        df.write.mode("overwrite").parquet(self.path(table, epoch, run))

    def _monitor(
        self, numbered: DataFrame, topics: DataFrame, sent: DataFrame, totals: dict, fetched: DataFrame,
        bad: DataFrame | None, now: int, took: int,
    ) -> DataFrame:
        """The flush as monitor records of all kinds."""
        flush = numbered.withColumn("flush", F.lit(0))
        topics = topics.select(F.col("topic").alias("name"))
        counted = sent.groupBy(F.col("topic").alias("name")).agg(F.sum("sent").alias("value"))
        # Topics of the routes that got nothing report 0.
        rows = topics.join(counted, "name", "full").withColumn("value", F.coalesce("value", F.lit(0)))
        delay = M.reported_delay(flush, F.lit(now), ["flush"]).select(
            F.col("topic").alias("name"), F.col("reported_delay_ms").alias("value")
        )
        last = delay.where(F.col("name") == M.BATCH_DELAY_NAME).agg(F.max("value").alias("d"))
        totals = numbered.sparkSession.range(1).select(
            F.lit(totals["send_num"] or 0).alias("n"), F.lit(totals["send_size"] or 0).alias("size"),
            F.lit(took).alias("took"), F.coalesce(last.scalar(), F.lit(0)).alias("delay"),
        )
        totals = M.measures(totals, dict(zip(M.SEND_MEASURES, ("n", "size", "took", "delay"), strict=True)))
        size = F.sum("_bytes") if "_bytes" in fetched.columns else F.lit(0)
        fetch = fetched.agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("size"), self._lag(fetched))
        fetch = M.measures(fetch, dict(zip(M.FETCH_MEASURES, ("n", "size", "lag"), strict=True)))
        parts = (("TOPIC_ROWS", rows), ("TOPIC_DELAY", delay), ("PERSIS", totals), ("FETCH", fetch))
        records = [M.monitor_record(values, kind, self.job) for kind, values in parts]
        hosts = fetched.where("ip is not null and ip != ''").select("ip").distinct()
        records.append(M.single_value_records(hosts, "IP", "ip", self.job))
        if bad is not None:
            told = bad.select(F.concat_ws(" ", "src_topic", "src_partition", "src_offset", DECODE_ERROR).alias("text"))
            records.append(M.single_value_records(told, "EXCEPTION", "text", self.job))
        return reduce(DataFrame.unionByName, records)

    @staticmethod
    def _lag(fetched: DataFrame):
        """Envelopes that the source holds beyond what was fetched, where it tells its latest offset."""
        if "latest_offset" not in fetched.columns:
            return F.lit(0).cast("bigint").alias("lag")
        beyond = F.max("latest_offset") - F.max("src_offset") - 1
        return F.greatest(F.lit(0), F.coalesce(beyond, F.lit(0))).cast("bigint").alias("lag")

    def start(self, envelopes: DataFrame, checkpoint: str, **trigger):
        """Start the query; ``trigger`` as for ``writeStream.trigger``, a second by default.

        A ``JobMonitor`` of this job's name, added to ``spark.streams``, gets its fetch totals.
        """
        from rowtide.sinks.topics import flush_trigger

        return (
            observed(envelopes).writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .queryName(self.job)
            .trigger(**(trigger or flush_trigger()))
            .start()
        )


def next_positions(
    batch: DataFrame, numbered: DataFrame, starts: DataFrame | None
) -> DataFrame:
    """State of each source partition after a batch: offset, last sequence, counters.

    Messages that did not decode have no sequence; they move the offset alone.

    Both sides are folded to one row per source partition before they meet. Partitions without
    new envelopes keep their row.
    """
    zero = F.lit(0).cast("bigint")
    topic = F.coalesce("src_topic", F.lit("")).alias("src_topic")
    seen = batch.groupBy(topic, "src_partition").agg(
        (F.max("src_offset") + 1).alias("_next"),
        F.max(
            F.struct(
                F.coalesce("batch_id", zero).alias("batch_id"), F.coalesce("in_id", zero).alias("in_id")
            )
        ).alias("_seq"),
    )
    end = is_end(F.col("entry_type"), F.col("is_ddl"))
    last = numbered.groupBy(*SOURCE).agg(
        F.max_by(
            F.struct(
                (F.col("out_batch_id") + end.cast("bigint")).alias("batch_id"),
                F.when(end, zero).otherwise(F.col("out_in_id") + 1).alias("in_id"),
                (F.col("first_mid") + F.col("row_count")).alias("mid"),
            ),
            "src_offset",
        ).alias("_last")
    )
    now = seen.join(last, list(SOURCE), "left")
    if starts is None:
        before = {n: F.lit(None).cast(POSITIONS[n].dataType) for n in POSITIONS.names}
    else:
        held = starts.select(*SOURCE, *[F.col(n).alias(f"_s_{n}") for n in _STATE])
        now = now.join(held, list(SOURCE), "full")
        before = {n: F.col(f"_s_{n}") for n in _STATE}
    had = F.when(
        before["last_batch_id"].isNotNull(),
        F.struct(before["last_batch_id"].alias("batch_id"), before["last_in_id"].alias("in_id")),
    )
    sequence = F.greatest(F.col("_seq"), had)
    return now.select(
        *SOURCE,
        F.greatest("_next", before["next_offset"]).alias("next_offset"),
        sequence["batch_id"].alias("last_batch_id"),
        sequence["in_id"].alias("last_in_id"),
        *[
            F.coalesce(F.col(f"_last.{n}"), before[n], zero).alias(n)
            for n in ("batch_id", "in_id", "mid")
        ],
    )


_STATE = (
    "next_offset", "last_batch_id", "last_in_id", "batch_id", "in_id", "mid",
)
