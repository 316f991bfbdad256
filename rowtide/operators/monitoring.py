"""Counts, sizes, delays and lag, and the monitor records that report them.

Every operator takes ``by``, the columns that name a flush (or a minute, an epoch); without it
the whole input is one flush. "Now" is always a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowtide.functions.avro_size import record_size
from rowtide.operators.ordering import ROW_COUNT, running_before, source_of
from rowtide.options import DEFAULT_WIDTHS

# Numeric ids of the monitor records by kind.
MONITOR_IDS = {
    "FETCH": 22001,
    "PERSIS": 22002,
    "EXCEPTION": 22003,
    "IP": 22004,
    "TOPIC_MONITOR": 22005,
    "TOPIC_ROWS": 31102,
    "TOPIC_DELAY": 31104,
}
# The ids before the exception and host kinds existed.
OLDER_MONITOR_IDS = {
    "FETCH": 22000,
    "PERSIS": 22001,
    "TOPIC_ROWS": 31102,
    "TOPIC_DELAY": 31104,
}
# The measures of the records that list several.
FETCH_MEASURES = ("FETCH_NUM", "FETCH_SIZE", "DELAY_NUM")
SEND_MEASURES = ("SEND_NUM", "SEND_SIZE", "SEND_TIME", "DELAY_TIME")
# Name under which the delay of the whole batch is listed among the topics; the choice is ours.
BATCH_DELAY_NAME = "DELAY_TIMES"


def rows_per_topic(routed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Emitted rows per topic, counted on the envelopes: no row is expanded for it."""
    return (
        routed.where(F.col(ROW_COUNT) > 0)
        .groupBy(*by, "topic")
        .agg(F.sum(F.col(ROW_COUNT).cast("bigint")).alias("row_num"))
    )


def zero_fill(rows: DataFrame, flush: str, last_flush: Column | None = None) -> DataFrame:
    """Report every topic in each flush from its first one on; silent topics report 0.

    ``flush`` counts flushes without gaps. ``last_flush`` defaults to the highest one in ``rows``.
    A topic's flushes are made block by block, so that no row holds all of them.
    """
    last = last_flush if last_flush is not None else rows.agg(F.max(flush)).scalar()
    known = _every_step(rows.groupBy("topic").agg(F.min(flush).alias("_first")), F.col("_first"), last, flush)
    return known.drop("_first").join(rows, ["topic", flush], "left").select(
        flush, "topic", F.coalesce("row_num", F.lit(0).cast("bigint")).alias("row_num")
    )


#: Steps that one row is expanded to at once.
_BLOCK = 2_048


def _every_step(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """A row for every whole number from first to last: blocks first, then the numbers of each.

    An array holds the blocks of a row or the numbers of a block; the blocks of a year of seconds
    are 15,400.
    """
    ends = df.withColumns({"_low": first.cast("bigint"), "_high": last.cast("bigint")})
    floor = lambda c: F.floor(F.col(c) / _BLOCK).cast("bigint")
    blocks = ends.withColumn("_block", F.explode(F.sequence(floor("_low"), floor("_high"))))
    low = F.greatest("_low", F.col("_block") * _BLOCK)
    high = F.least("_high", F.col("_block") * _BLOCK + (_BLOCK - 1))
    return blocks.withColumn(name, F.explode(F.sequence(low, high))).drop("_low", "_high", "_block")


def topic_delay(routed: DataFrame, now: Column, by: Sequence[str] = ()) -> DataFrame:
    """Delay of each topic: now minus the execute time of its last envelope."""
    return routed.groupBy(*by, "topic").agg(_last_delay(now).alias("delay_ms"))


def batch_delay(routed: DataFrame, now: Column, by: Sequence[str] = ()) -> DataFrame:
    """Delay of each flush: now minus the execute time of its last envelope."""
    return routed.groupBy(*by).agg(_last_delay(now).alias("batch_delay_ms"))


def reported_delay(routed: DataFrame, now: Column, by: Sequence[str]) -> DataFrame:
    """Delays as they are reported: every topic shows the batch delay; the raw one is kept beside.

    One more entry per flush carries the batch delay itself. Both come from one grouping: the
    last envelope of a flush is the last one of its topics' last envelopes.
    """
    last = F.max(F.struct("src_offset", "src_partition", _delay(now).alias("delay")))
    topics = routed.groupBy(*by, "topic").agg(last.alias("_last"))
    flush = topics.groupBy(*by).agg(F.max("_last").alias("_batch"))
    listed = topics.select(*by, "topic", F.col("_last.delay").alias("raw_delay_ms")).unionByName(
        flush.select(
            *by, F.lit(BATCH_DELAY_NAME).alias("topic"), F.col("_batch.delay").alias("raw_delay_ms")
        )
    )
    return listed.join(
        flush.select(*by, F.col("_batch.delay").alias("reported_delay_ms")), list(by)
    )


def send_stats(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number and encoded bytes of the records sent per flush."""
    return records.groupBy(*by).agg(*_send_totals(records))


def observed_sends(records: DataFrame, totals: Observation) -> DataFrame:
    """The records, with ``send_num`` and ``send_size`` of those with a key counted as they are written."""
    return records.observe(totals, *_send_totals(records, F.col("key").isNotNull()))


def _send_totals(records: DataFrame, sent: Column | None = None) -> list[Column]:
    size = F.octet_length("value") if "value" in records.columns else record_size()
    one, size = F.lit(1), size.cast("bigint")
    if sent is not None:
        one, size = F.when(sent, one), F.when(sent, size)
    return [F.count(one).alias("send_num"), F.sum(size).alias("send_size")]


def fetch_per_minute(fetch_log: DataFrame, **more: Column) -> DataFrame:
    """Messages and bytes fetched per source partition and minute, before any filter; ``more`` adds aggregates."""
    source = source_of(fetch_log)
    return (
        fetch_log.groupBy(*source, F.window("fetch_ts", "1 minute").alias("_w"))
        .agg(
            F.count("*").alias("fetch_num"), F.sum("n_bytes").alias("fetch_size"),
            *[column.alias(name) for name, column in more.items()],
        )
        .select(*source, F.col("_w.start").alias("minute"), "fetch_num", "fetch_size", *more)
    )


def offset_lag(
    fetch_log: DataFrame, starts: DataFrame | None = None, widths: Sequence[int] = DEFAULT_WIDTHS
) -> DataFrame:
    """Offset lag at the end of every minute, silent minutes included.

    A minute without a fetch keeps the last known offset, at first the start position (column
    ``start_offset`` of ``starts``, else 0); an offset of 0 is not known. One of 0 or less, or
    beyond the latest, is no lag. The log is folded to one row per minute with a fetch; what was
    known before and where the next such minute is are running values over chunks of these, and
    each is then repeated up to the next, so no task or row holds all minutes of a partition.
    """
    source = source_of(fetch_log)
    zero = "timestamp_ntz'1970-01-01 00:00:00'"
    minutes = fetch_log.groupBy(
        *source, F.expr(f"timestampdiff(MINUTE, {zero}, cast(window(fetch_ts, '1 minute').start as timestamp_ntz))").alias("_at")
    ).agg(F.max("next_offset").alias("_now"), F.max_by("latest_offset", "next_offset").alias("last_offset"))
    known = F.when(F.col("_now") != 0, F.struct("_at", "_now"))
    minutes = running_before(minutes, source, "_at", maxes={"_known": known}, widths=widths)
    minutes = minutes.withColumn("_back", -F.col("_at"))
    minutes = running_before(minutes, source, "_back", maxes={"_later": F.col("_back")}, widths=widths)
    filled = _every_step(minutes, F.col("_at"), F.coalesce(-F.col("_later") - 1, F.col("_at")), "_minute")
    if starts is not None:
        filled = filled.join(starts.select(*source, "start_offset"), source, "left")
        start = F.coalesce("start_offset", F.lit(0))
    else:
        start = F.lit(0)
    now = F.coalesce(F.when(F.col("_now") != 0, F.col("_now")), F.col("_known._now"), start)
    shown = F.when((now <= 0) | (now > F.col("last_offset")), F.col("last_offset")).otherwise(now)
    return filled.select(
        *source,
        F.expr(f"timestampadd(MINUTE, _minute, {zero})").alias("minute"),
        shown.alias("now_offset"),
        "last_offset",
        (F.col("last_offset") - shown).alias("delay_num"),
    )


def fetch_totals(
    fetch_log: DataFrame, every: int = 10_001, widths: Sequence[int] = DEFAULT_WIDTHS
) -> DataFrame:
    """Count, bytes and elapsed time of each run of ``every`` messages of a source partition."""
    counted = running_before(
        fetch_log,
        source_of(fetch_log),
        "next_offset",
        sums={"_n": F.lit(1).cast("bigint")},
        widths=widths,
    ).withColumn("run_no", F.floor(F.col("_n") / F.lit(every)).cast("bigint"))
    return counted.groupBy(*source_of(fetch_log), "run_no").agg(
        F.count("*").alias("fetch_num"),
        F.sum("n_bytes").alias("fetch_size"),
        F.timestamp_diff("MILLISECOND", F.min("fetch_ts"), F.max("fetch_ts")).alias("elapsed_ms"),
        (F.count("*") == every).alias("complete"),
    )


def monitor_record(
    values: DataFrame,
    kind: str,
    job: Column | str,
    by: Sequence[str] = (),
    ids: Mapping[str, int] = MONITOR_IDS,
) -> DataFrame:
    """Monitor records from (name, value) rows: one record with a JSON map per flush.

    The map is the record's content and holds one entry per name, so it is as long as the list
    of topics or measures, which were aggregated before. A kind without an id gives ``{}``.
    """
    job = job if isinstance(job, Column) else F.lit(job)
    pairs = F.array_sort(F.collect_list(F.struct("name", "value")))
    content = F.to_json(F.map_from_entries(pairs)) if kind in ids else F.lit("{}")
    return values.groupBy(*by).agg(content.alias("content")).select(
        *by,
        F.lit(ids.get(kind, 0)).cast("int").alias("id"),
        job.alias("jrdw_mark"),
        "content",
    )


def single_value_records(rows: DataFrame, kind: str, value: str, job: Column | str) -> DataFrame:
    """One monitor record per row: an exception text or a host address."""
    job = job if isinstance(job, Column) else F.lit(job)
    return rows.select(
        F.lit(MONITOR_IDS[kind]).cast("int").alias("id"),
        job.alias("jrdw_mark"),
        F.to_json(F.create_map(F.lit(kind), F.col(value))).alias("content"),
    )


def measures(row: DataFrame, columns: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Turn measure columns into (name, value) rows for ``monitor_record``."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(column).cast("bigint").alias("value"))
            for name, column in columns.items()
        ]
    )
    return row.select(*by, F.inline(pairs))


def monitor_message(monitor: DataFrame) -> DataFrame:
    """Monitor records as the JSON text that goes to the monitor topic."""
    return monitor.select(F.to_json(F.struct("id", "jrdw_mark", "content")).alias("value"))


def _delay(now: Column) -> Column:
    return now - F.coalesce("header.execute_time", F.lit(0))


def _last_delay(now: Column) -> Column:
    return F.max_by(_delay(now), F.struct("src_offset", "src_partition"))
