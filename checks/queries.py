"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide import VARIANTS, ConvertOptions, convert, prepare_session, samples
from rowtide.session import tune_session
from rowtide.functions import text as X
from rowtide.operators import audit as U
from rowtide.operators import digests as DG
from rowtide.operators import envelopes as V
from rowtide.operators import job_configs as J
from rowtide.operators import monitoring as M
from rowtide.operators import ordering as O
from rowtide.operators import reconcile as C
from rowtide.operators import records as R
from rowtide.operators import routing as G
from rowtide.plans import convert as P
from rowtide.plans import stored as D
from rowtide.sinks import commits as KC
from rowtide.sinks import digests as KD
from rowtide.sinks import store as KS
from rowtide.sinks import tables as KT
from rowtide.sinks import topics as KP
from rowtide.sources import config as SC
from rowtide.sources import json_changes as SJ
from rowtide.sources import positions as SP
from rowtide.sources import tables as ST
from rowtide.sources import topic_log as SL
from rowtide.sources import wire as SW
from rowtide.streaming import monitor as LM
from rowtide.streaming.conversion import next_positions
from rowtide.streaming.minutes import MinuteCounts

Query = Callable[[SparkSession, str], DataFrame]

# Record time and "now", in milliseconds.
TS = 1_700_000_000_000
NOW = 1_800_000_000_000
KEYS = ("order_key", "row_no")
HELD = ConvertOptions(on_missing_key="quarantine")
# For what reads no record id.
UNNUMBERED = HELD.but(numbers=False)
PLACE = ("src_partition", "src_offset")
ROW = (*PLACE, "row_no")

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune_session(prepare_session(spark))
    # Python workers import the package too; on a cluster it is shipped with --py-files.
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, paths)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.change_log(_table(spark, sf_dir, "orders"))


def _routes(spark: SparkSession) -> DataFrame:
    return G.normalize_routes(samples.route_table(spark))


def _routed(spark: SparkSession, sf_dir: str, options: ConvertOptions = HELD) -> DataFrame:
    return P.routed_envelopes(_log(spark, sf_dir), _routes(spark), options)


def _records(spark: SparkSession, sf_dir: str, options: ConvertOptions = HELD) -> DataFrame:
    return convert(_log(spark, sf_dir), _routes(spark), TS, options)


def _images(spark: SparkSession, sf_dir: str, *opts: str, options=HELD) -> DataFrame:
    rows = P.rows_with_images(_routed(spark, sf_dir, options), options)
    if opts:
        rows = rows.where(F.col("event_type").isin(*opts))
    return rows


def _flushed(routed: DataFrame) -> DataFrame:
    return routed.withColumn("flush_no", F.expr("batch_id div 100"))


# --- sources ---------------------------------------------------------------------------------


@_query
def s1_tail_from_position(spark, sf_dir):
    log = _log(spark, sf_dir)
    half = log.groupBy("src_topic", "src_partition").agg(F.expr("max(src_offset) div 2").alias("next_offset"))
    return ST.from_positions(log, half).select(*PLACE, "batch_id", "in_id")


@_query
def s2_read_from_offset(spark, sf_dir):
    log = _log(spark, sf_dir)
    parts = [
        ST.from_offset(log, start).agg(
            F.count("*").alias("envelopes"), F.min("src_offset").alias("first_offset")
        ).select(F.lit(str(start)).alias("start"), "envelopes", "first_offset")
        for start in ("earliest", 1000, "latest")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query
def s3_resolve_position(spark, sf_dir):
    texts = samples.position_texts(_table(spark, sf_dir, "customer"))
    forms = [
        SP.start_mid(SP.parse_positions(texts, form=form), 7).withColumn("form", F.lit(form))
        for form in ("strict", "lenient")
    ]
    return forms[0].unionByName(forms[1])


@_query
def s4_clamp_offset(spark, sf_dir):
    events = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_id as requested", "user_id * 20 as earliest",
        "user_id * 20 + 3000 as latest", "event_id % 3 > 0 as flagged",
    )
    arguments = (F.col("requested"), F.col("earliest"), F.col("latest"), F.col("flagged"))
    return events.select(
        "event_id",
        SP.clamp_offset(*arguments).alias("clamped"),
        SP.to_latest_offset(arguments[0], arguments[2], arguments[3]).alias("older_form"),
    )


@_query
def s5_range_scan(spark, sf_dir):
    stored = samples.stored_events(_table(spark, sf_dir, "events"))
    return ST.successive_scans(stored, 300, widths=(1024,)).select(
        "scan_no", "event_row", F.col("event_bytes").cast("string").alias("event_text")
    )


@_query
def s7_decode_envelopes(spark, sf_dir):
    decoded = SW.decoded_ok(SW.decode_envelopes(SW.encode_envelopes(_log(spark, sf_dir))))
    rows = decoded.select(
        *PLACE, "entry_type", "batch_id", "in_id", "ip",
        F.col("header.table_name").alias("table_name"),
        F.col("header.execute_time").alias("execute_time"),
        F.col("row_change.is_ddl").alias("is_ddl"),
        F.col("row_change.event_type").alias("event_type"),
        F.posexplode_outer("row_change.row_datas").alias("row_no", "_row"),
    )
    # The sides that have cells, so that no cell is copied into a list of both.
    before, after = (
        F.struct(F.lit(name).alias("side"), F.col(f"_row.{name}").alias("cells")) for name in ("before", "after")
    )
    some_before, some_after = F.size("_row.before") > 0, F.size("_row.after") > 0
    sides = (
        F.when(some_before & some_after, F.array(before, after))
        .when(some_before, F.array(before)).when(some_after, F.array(after))
    )
    rows = rows.select(*rows.columns[:-1], F.explode_outer(sides).alias("_side"))
    return rows.select(
        *rows.columns[:-1], F.col("_side.side").alias("side"), F.explode_outer("_side.cells").alias("cell")
    ).select(
        *rows.columns[:-1], "side", F.col("cell.name").alias("name"),
        F.col("cell.value").alias("value"), F.col("cell.is_null").alias("is_null"),
        F.col("cell.is_key").alias("is_key"), F.col("cell.updated").alias("updated"),
        F.col("cell.mysql_type").alias("mysql_type"),
    )


@_query
def s8_decode_records(spark, sf_dir):
    encoded = SW.encode_records(_records(spark, sf_dir))
    decoded = SW.decoded_ok(SW.decode_records(encoded))
    return U.image_cells(decoded, *ROW, "mid", "db", "tab", "opt", "ts", "ddl", "err")


@_query
def s9_decode_json(spark, sf_dir):
    messages = samples.json_messages(_records(spark, sf_dir))
    return SJ.decode_json_changes(messages).select(
        *ROW, "schema", "table", "operation", X.map_dump(F.col("fields")).alias("fields")
    )


@_query
def s10_load_routes(spark, sf_dir):
    return _route_listing(samples.job_configs(_table(spark, sf_dir, "customer")))


@_query
def s11_load_routes_array(spark, sf_dir):
    configs = samples.job_configs(_table(spark, sf_dir, "customer"))
    return _route_listing(configs.where(F.col("config").startswith("["))).drop("sensitive")


def _route_listing(configs: DataFrame) -> DataFrame:
    return SC.load_routes(configs).select(
        "job", "dbname", "tablename", "topic", "source_type",
        F.array_join("key_columns", "|").alias("key_columns"),
        F.array_join("sensitive", "|").alias("sensitive"),
    )


@_query
def s12_load_sensitive(spark, sf_dir):
    documents = samples.sensitive_documents(_table(spark, sf_dir, "customer"))
    return SC.load_sensitive(documents).withColumn("sensitive", F.array_join("sensitive", "|"))


# --- projections, filters, row generation ----------------------------------------------------


@_query
def f1_drop_repeats(spark, sf_dir):
    return O.drop_repeats(_log(spark, sf_dir)).select(*PLACE, "batch_id", "in_id")


def _two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log twice: the second topic has the same partitions and offsets between the first's."""
    log = _log(spark, sf_dir)
    second = log.withColumn("src_topic", F.lit("more_changes")).withColumn("src_offset", F.col("src_offset") + 3)
    return log.unionByName(second)


@_query
def f1_two_topics(spark, sf_dir):
    kept = O.drop_repeats(_two_topics(spark, sf_dir), widths=(512, 8))
    return kept.select("src_topic", *PLACE, "batch_id", "in_id")


@_query
def n3_two_topics(spark, sf_dir):
    options = HELD.but(widths=(512,))
    routed = P.routed_envelopes(_two_topics(spark, sf_dir), _routes(spark), options)
    return O.number_envelopes(routed, widths=options.widths).select(
        "src_topic", *PLACE, "out_batch_id", "out_in_id", "first_mid"
    )


@_query
def f2_repeated_routes(spark, sf_dir):
    """Routes of several jobs that name the same tables: the last job counts, lists are merged."""
    entries = samples.repeated_routes(_table(spark, sf_dir, "customer"))
    routes = SC.job_routes(entries)
    options = UNNUMBERED.but(drop_repeats=False)
    direct = P.routed_envelopes(_log(spark, sf_dir), routes, options)
    records = convert(_log(spark, sf_dir), routes, TS, options)
    counts = [
        direct.groupBy("topic").agg(F.sum("row_count").cast("bigint").alias("n")).withColumn("part", F.lit("rows")),
        records.groupBy("topic").agg(F.count("*").alias("n")).withColumn("part", F.lit("records")),
        records.groupBy("topic").agg(F.sum(F.size("cur").cast("bigint")).alias("n")).withColumn("part", F.lit("cells")),
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).where("n > 0")


@_query
def f1_repeat_counts(spark, sf_dir):
    flagged = O.mark_repeats(_log(spark, sf_dir))
    return flagged.groupBy("src_topic", "src_partition").agg(
        F.count("*").alias("envelopes"), F.count_if("is_repeat").alias("repeats")
    )


@_query
def f2_route_filter(spark, sf_dir):
    return _routed(spark, sf_dir).select(*PLACE, "topic")


@_query
def f2b_default_topic(spark, sf_dir):
    none = G.normalize_routes(samples.route_table(spark, ()))
    options = HELD.but(default_topic="mysql_all")
    routed = P.routed_envelopes(_log(spark, sf_dir), none, options)
    return routed.groupBy("topic", "entry_type").agg(F.count("*").alias("envelopes"))


@_query
def f3_dml_only(spark, sf_dir):
    return G.dml_only(_routed(spark, sf_dir)).select(*PLACE, "row_change.event_type")


@_query
def f3b_ddl_log(spark, sf_dir):
    return G.ddl_log(_routed(spark, sf_dir))


@_query
def f4_row_expansion(spark, sf_dir):
    rows = R.expand_rows(G.dml_only(_routed(spark, sf_dir)))
    return rows.select(
        *ROW, F.size("before").alias("before_cells"), F.size("after").alias("after_cells")
    )


@_query
def f5_operation_label(spark, sf_dir):
    from rowtide.functions.cells import operation_label

    label = operation_label(F.col("row_change.event_type"))
    return _log(spark, sf_dir).groupBy(label.alias("opt")).agg(F.count("*").alias("envelopes"))


@_query
def f6_insert_image(spark, sf_dir):
    return U.image_cells(_images(spark, sf_dir, "INSERT"), *ROW)


@_query
def f7_delete_image(spark, sf_dir):
    return U.image_cells(_images(spark, sf_dir, "DELETE"), *ROW)


@_query
def f8_update_image_changed(spark, sf_dir):
    return U.image_cells(_images(spark, sf_dir, "UPDATE"), *ROW)


@_query
def f8b_update_image_full(spark, sf_dir):
    return U.image_cells(
        _images(spark, sf_dir, "UPDATE", options=HELD.but(update_image="full")), *ROW
    )


@_query
def f9_other_event(spark, sf_dir):
    rows = _images(spark, sf_dir).where(~F.col("event_type").isin("INSERT", "UPDATE", "DELETE"))
    return rows.select(
        *ROW, "event_type", F.size("src").alias("src_size"), F.size("cur").alias("cur_size")
    )


@_query
def f10_null_as_empty(spark, sf_dir):
    return U.image_cells(_images(spark, sf_dir, options=HELD.but(null_mode="empty")), *ROW)


@_query
def f11_sensitive_columns(spark, sf_dir):
    kept = U.image_cells(_images(spark, sf_dir), "topic", "header")
    every = U.image_cells(
        _images(spark, sf_dir, options=HELD.but(drop_sensitive=False)), "topic", "header"
    )
    counts = [
        cells.groupBy(F.col("header.table_name").alias("tab"), "side", "name").agg(
            F.count("*").alias(label)
        )
        for label, cells in (("kept", kept), ("unfiltered", every))
    ]
    return counts[1].join(counts[0], ["tab", "side", "name"], "left").select(
        "tab", "side", "name", "unfiltered", F.coalesce("kept", F.lit(0)).alias("kept")
    )


@_query
def f12_business_key(spark, sf_dir):
    return _images(spark, sf_dir).where(F.col("key").isNotNull()).select(*ROW, "topic", "key")


@_query
def f13_missing_key(spark, sf_dir):
    options = UNNUMBERED.but(on_missing_key="batch_time")
    records = _records(spark, sf_dir, options)
    return records.where(F.col("key") == str(TS)).select(*ROW, "topic", "key", "opt")


@_query
def f13_quarantine(spark, sf_dir):
    return R.quarantined(_records(spark, sf_dir, UNNUMBERED)).groupBy("topic", "tab", "opt").agg(
        F.count("*").alias("rows")
    )


@_query
def f14_records(spark, sf_dir):
    records = _records(spark, sf_dir)
    return records.select(
        *ROW, "topic", "key", "mid", "db", "sch", "tab", "opt", "ts", "ddl", "err",
        *[X.map_dump(F.col(side)).alias(side) for side in ("src", "cur", "cus")],
    )


@_query
def f14_records_local_form(spark, sf_dir):
    records = _records(spark, sf_dir, VARIANTS["local"])
    return records.select(
        *ROW, "topic", "key", "mid", *[X.map_dump(F.col(s)).alias(s) for s in ("src", "cur")]
    )


@_query
def f14_records_unfiltered_form(spark, sf_dir):
    records = _records(spark, sf_dir, VARIANTS["local_unfiltered"])
    return records.select(*ROW, "topic", "key", "mid", X.map_dump(F.col("cur")).alias("cur"))


@_query
def f15_custom_map(spark, sf_dir):
    return _records(spark, sf_dir, UNNUMBERED).select(
        *ROW, F.col("cus.dmlts").alias("dmlts"), F.col("cus.ip").alias("ip")
    )


@_query
def f16_envelope_conversion(spark, sf_dir):
    records = V.envelope_records(_log(spark, sf_dir), F.lit(TS))
    return records.select(
        *PLACE, "mid", "db", "tab", "opt", "ts", "ddl", "err",
        F.when(F.col("src").isNotNull(), X.map_dump(F.col("src"))).alias("src"),
        F.when(F.col("cur").isNotNull(), X.map_dump(F.col("cur"))).alias("cur"),
    )


@_query
def f17_last_row_per_key(spark, sf_dir):
    numbered = O.number_envelopes(_routed(spark, sf_dir))
    last = V.last_row_per_key(numbered, F.lit(TS), "quarantine")
    return last.select(
        *ROW, "topic", "key", "mid", "opt", "ddl",
        F.when(F.col("src").isNotNull(), X.map_dump(F.col("src"))).alias("src"),
        F.when(F.col("cur").isNotNull(), X.map_dump(F.col("cur"))).alias("cur"),
    )


@_query
def f18_end_predicate(spark, sf_dir):
    return V.with_end_flag(_log(spark, sf_dir)).select(*PLACE, "is_end")


@_query
def f19_envelope_summary(spark, sf_dir):
    return V.summarize(_log(spark, sf_dir))


@_query
def f19_last_of_flush(spark, sf_dir):
    summaries = V.summarize(_flushed(_log(spark, sf_dir)), keep=["flush_no"])
    return V.last_of(summaries, ["src_partition", "flush_no"])


@_query
def f20_readable(spark, sf_dir):
    return V.readable(_log(spark, sf_dir), F.lit(NOW)).drop("src_topic")


@_query
def f21_stored_records(spark, sf_dir):
    entries = D.converted_entries(_log(spark, sf_dir), F.lit(TS), start=100)
    return entries.select("src_partition", "entry_row", F.hex("value").alias("value_hex"))


# --- numbering -------------------------------------------------------------------------------


@_query
def n1_n2_batch_numbers(spark, sf_dir):
    options = HELD.but(default_topic="mysql_all")
    none = G.normalize_routes(samples.route_table(spark, ()))
    routed = P.routed_envelopes(_log(spark, sf_dir), none, options)
    return O.number_envelopes(routed, _starts(routed)).select(*PLACE, "out_batch_id", "out_in_id")


def _starts(routed: DataFrame) -> DataFrame:
    """Checkpoint values per source partition, taken from the log."""
    return routed.groupBy("src_topic", "src_partition").agg(
        F.max("batch_id").alias("batch_id"),
        F.max("in_id").alias("in_id"),
        F.max("src_offset").alias("mid"),
    )


@_query
def n3_record_id(spark, sf_dir):
    numbered = O.number_envelopes(_routed(spark, sf_dir))
    rows = R.expand_rows(G.dml_only(numbered))
    return rows.select(*ROW, (F.col("first_mid") + F.col("row_no")).alias("mid"))


@_query
def n3_record_id_two_levels(spark, sf_dir):
    """The same ids with small chunks folded twice."""
    options = HELD.but(widths=(512, 8))
    numbered = O.number_envelopes(_routed(spark, sf_dir, options), widths=options.widths)
    return numbered.select(*PLACE, "out_batch_id", "out_in_id", "first_mid")


@_query
def n4_running_row_key(spark, sf_dir):
    return O.running_row_key(_log(spark, sf_dir), "src_offset", 100).select(*PLACE, "entry_row")


# --- aggregations and monitoring -------------------------------------------------------------


@_query
def a1_rows_per_topic(spark, sf_dir):
    return M.rows_per_topic(_routed(spark, sf_dir))


@_query
def a2_zero_fill(spark, sf_dir):
    flushed = _routed(spark, sf_dir).withColumn("flush_no", F.col("batch_id"))
    return M.zero_fill(M.rows_per_topic(flushed, ["flush_no"]), "flush_no")


@_query
def a3_topic_delay(spark, sf_dir):
    return M.topic_delay(_flushed(_routed(spark, sf_dir)), F.lit(NOW), ["flush_no"])


@_query
def a4_batch_delay(spark, sf_dir):
    return M.batch_delay(_flushed(_routed(spark, sf_dir)), F.lit(NOW), ["flush_no"])


@_query
def a5_reported_delay(spark, sf_dir):
    return M.reported_delay(_flushed(_routed(spark, sf_dir)), F.lit(NOW), ["flush_no"])


@_query
def a6_send_stats(spark, sf_dir):
    return M.send_stats(R.with_key(_records(spark, sf_dir)), ["topic"])


@_query
def a7_fetch_per_minute(spark, sf_dir):
    fetched = M.fetch_per_minute(samples.fetch_log(_table(spark, sf_dir, "events")))
    return fetched.withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@_query
def a8_offset_lag(spark, sf_dir):
    log = samples.fetch_log(_table(spark, sf_dir, "events"))
    lag = M.offset_lag(log)
    return lag.withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@_query
def a9_fetch_totals(spark, sf_dir):
    return M.fetch_totals(samples.fetch_log(_table(spark, sf_dir, "events")), 501)


@_query
def a10_monitor_records(spark, sf_dir):
    flushed = _flushed(_routed(spark, sf_dir))
    rows = M.rows_per_topic(flushed, ["flush_no"]).select(
        "flush_no", F.col("topic").alias("name"), F.col("row_num").alias("value")
    )
    delays = M.reported_delay(flushed, F.lit(NOW), ["flush_no"]).select(
        "flush_no", F.col("topic").alias("name"), F.col("reported_delay_ms").alias("value")
    )
    return M.monitor_record(rows, "TOPIC_ROWS", "job_1", ["flush_no"]).unionByName(
        M.monitor_record(delays, "TOPIC_DELAY", "job_1", ["flush_no"])
    )


@_query
def a10b_older_monitor_records(spark, sf_dir):
    log = samples.fetch_log(_table(spark, sf_dir, "events"))
    values = M.measures(
        M.fetch_per_minute(log).withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm")),
        {"FETCH_NUM": "fetch_num", "FETCH_SIZE": "fetch_size"},
        ["src_partition", "minute"],
    )
    by = ["src_partition", "minute"]
    known = M.monitor_record(values, "FETCH", "job_1", by, M.OLDER_MONITOR_IDS)
    unknown = M.monitor_record(values, "IP", "job_1", by, M.OLDER_MONITOR_IDS)
    return known.unionByName(unknown)


@_query
def a11_exception_and_host_records(spark, sf_dir):
    held = R.quarantined(_records(spark, sf_dir)).select(
        F.concat(
            F.lit("no key: "), "tab", F.lit("@"), F.col("src_offset").cast("string"),
            F.lit("/"), F.col("row_no").cast("string"),
        ).alias("message")
    )
    hosts = _log(spark, sf_dir).select("ip").distinct()
    return M.single_value_records(held, "EXCEPTION", "message", "job_1").unionByName(
        M.single_value_records(hosts, "IP", "ip", "job_1")
    )


# --- reconciliation and audit ----------------------------------------------------------------


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    records = _records(spark, sf_dir, UNNUMBERED)
    messages = SJ.decode_json_changes(samples.json_messages(records))
    delivered = records.where((F.col("src_offset") / 2).cast("bigint") % 50 != 7)
    return C.json_keys(messages, KEYS), C.record_keys(delivered, KEYS)


@_query
def r1_record_key(spark, sf_dir):
    keyed = C.record_keys(_records(spark, sf_dir, UNNUMBERED), ("product_id", "return_flag", "order_key"))
    return keyed.select(*ROW, "change_key")


@_query
def r2_json_key(spark, sf_dir):
    return _sides(spark, sf_dir)[0].select(*ROW, "change_key")


@_query
def r3_missing_changes(spark, sf_dir):
    return C.missing_changes(*_sides(spark, sf_dir))


@_query
def r3_missing_count(spark, sf_dir):
    return C.missing_count(*_sides(spark, sf_dir))


@_query
def r4_capture_counts(spark, sf_dir):
    json_side, record_side = _sides(spark, sf_dir)
    record_side = record_side.withColumn("execute_time", F.col("cus.dmlts").cast("bigint"))
    start, year = F.lit(820_454_400_000), F.lit(3 * 31_536_000_000)
    return C.capture_counts(json_side, record_side, "execute_time", start, year)


@_query
def r5_table_probe(spark, sf_dir):
    return U.tables_like(_records(spark, sf_dir, UNNUMBERED), "_2").select(*ROW, "db", "tab")


@_query
def r6_listed_columns(spark, sf_dir):
    return U.listed_columns(_log(spark, sf_dir))


@_query
def r6_watched_cells(spark, sf_dir):
    watched = samples.watch_list(_table(spark, sf_dir, "part"))
    return U.watched_cells(_log(spark, sf_dir), watched)


@_query
def r7_watched_values(spark, sf_dir):
    watched = samples.watch_list(_table(spark, sf_dir, "part"))
    return U.watched_values(_records(spark, sf_dir, UNNUMBERED), watched)


@_query
def r8_null_audit(spark, sf_dir):
    return U.null_audit(_records(spark, sf_dir, UNNUMBERED))


@_query
def r9_map_dump(spark, sf_dir):
    return U.dump_maps(_records(spark, sf_dir, UNNUMBERED))


@_query
def r10_topic_dump(spark, sf_dir):
    return U.dump_records(_records(spark, sf_dir))


@_query
def r11_routed_tables(spark, sf_dir):
    return J.routed_tables(samples.job_configs(_table(spark, sf_dir, "customer")))


@_query
def r12_sensitive_configs(spark, sf_dir):
    return J.sensitive_configs(samples.job_configs(_table(spark, sf_dir, "customer")))


# --- sinks and partitioning ------------------------------------------------------------------


@_query
def k1_keyed_messages(spark, sf_dir):
    messages = KP.keyed_messages(R.with_key(_records(spark, sf_dir)))
    return messages.select("topic", "key", F.hex("value").alias("value_hex"))


@_query
def k2_stored_entries(spark, sf_dir):
    return D.readable_entries(_log(spark, sf_dir), F.lit(NOW)).drop("src_topic")


@_query
def k3_positions(spark, sf_dir):
    log = _log(spark, sf_dir)
    numbered = P.numbered_images(log, _routes(spark), HELD)
    return SP.positions_as_text(next_positions(log, numbered, None)).select(
        "src_partition", "last_batch_id", "last_in_id", "position"
    )


@_query
def k4_position_history(spark, sf_dir):
    positions = _log(spark, sf_dir).select(
        F.concat(F.lit("job_"), (F.col("src_offset") % 3).cast("string")).alias("job"),
        F.col("src_offset").alias("step"),
        "src_topic", "src_partition", (F.col("src_offset") + 1).alias("next_offset"),
        "batch_id", "in_id", F.col("header.execute_time").alias("written_at"),
    )
    return KT.position_history(positions)


@_query
def k5_monitor_messages(spark, sf_dir):
    rows = M.rows_per_topic(_routed(spark, sf_dir)).select(
        F.col("topic").alias("name"), F.col("row_num").alias("value")
    )
    return M.monitor_message(M.monitor_record(rows, "TOPIC_ROWS", "job_1"))


@_query
def p1_key_partitions(spark, sf_dir):
    keyed = R.with_key(_records(spark, sf_dir, UNNUMBERED)).select("topic", "key")
    return KP.with_key_partition(keyed, 16).groupBy("key", "partition").agg(F.count("*").alias("messages"))


@_query
def p2_suffix_partitions(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "case o_orderkey % 5 when 0 then concat('nodot', o_orderkey) "
        "when 1 then concat('.', o_orderkey) else concat('order.', o_orderkey) end as key"
    )
    placed = KP.with_numeric_partition(orders, 12)
    return placed.groupBy("partition").agg(F.count("*").alias("messages"))


# --- live source, epochs, store and placement ------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """A new folder below the shared one; a local session without it gets one of its machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = Path(tempfile.mkdtemp(prefix="rowtide-")).as_uri()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def _streamed(spark: SparkSession, log: str, work: str, name: str, **options) -> DataFrame:
    """What a query of limited batches has read of the log when it has read all."""
    checkpoint = f"{work}/checkpoint"
    query = (
        LM.observed(SL.read_log(spark, log, checkpoint=checkpoint, **options)).writeStream.queryName(name)
        .foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{work}/read/epoch={epoch}"))
        .option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(f"{SL.MESSAGE}, epoch bigint").parquet(f"{work}/read")


@_query
def s1_live_tail(spark, sf_dir):
    """Partition 0 starts below its earliest offset, 2 beyond its latest, 3 has no position."""
    work = _scratch(spark)
    messages = samples.event_messages(_table(spark, sf_dir, "events")).where("src_partition != 0 or src_offset >= 50")
    SL.append_segments(messages, f"{work}/log", segment_rows=512).write.format("noop").mode("overwrite").save()
    starting = json.dumps({"events": {"0": 10, "1": 150, "2": 10**12}})
    rows = _streamed(spark, f"{work}/log", work, f"tail-{uuid.uuid4().hex}", starting=starting, max_rows=messages.count() // 3)
    return rows.select(*PLACE, "latest_offset", F.col("value").cast("string").alias("value"))


@_query
def a9_live_totals(spark, sf_dir):
    """The monitor rows of a stream, added up: messages and bytes fetched, and the lag of its last batch."""
    work = _scratch(spark)
    messages = samples.event_messages(_table(spark, sf_dir, "events"))
    SL.append_segments(messages, f"{work}/log", segment_rows=512).write.format("noop").mode("overwrite").save()
    job = f"totals-{uuid.uuid4().hex}"
    told = LM.JobMonitor(spark, job, work, lambda: SL.latest_offsets(SL.segments(f"{work}/log")))
    spark.streams.addListener(told)
    try:
        _streamed(spark, f"{work}/log", work, job, max_rows=messages.count() // 3)
        until = time.time() + 120
        while told.running() and time.time() < until:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(told)
    fetch = LM.live_rows(spark, work).where(F.col("id") == M.MONITOR_IDS["FETCH"])
    values = fetch.select("batch_id", F.from_json("content", "FETCH_NUM bigint, FETCH_SIZE bigint, DELAY_NUM bigint").alias("v"))
    return values.agg(
        F.sum("v.FETCH_NUM").alias("fetch_num"), F.sum("v.FETCH_SIZE").alias("fetch_size"),
        F.max_by("v.DELAY_NUM", "batch_id").alias("delay_num"),
    )


@_query
def k3_committed_epochs(spark, sf_dir):
    """Epochs of 1,024 events: odd ones after the first ten are never published; the first four are merged."""
    out = _scratch(spark)
    events = _table(spark, sf_dir, "events").selectExpr("event_id", "event_type as topic", "event_id div 1024 as epoch")
    events.withColumn("run", F.lit("a")).write.partitionBy("run", "epoch").parquet(f"{out}/records")
    epochs = sorted(r.epoch for r in events.select("epoch").distinct().collect())
    schema = events.select("event_id", "topic").schema
    for epoch in epochs:
        if epoch < 10 or epoch % 2 == 0:
            KC.publish(out, "a", epoch, ["records"])
        if epoch == 3:
            KC.compact(spark, out, "records", schema, ["event_id"], ["topic"])
    return KC.read_committed(spark, out, "records", schema).select("event_id", "topic", "epoch")


@_query
def s5_zone_scan(spark, sf_dir):
    """Scans of a store of two appends: one that ends at an empty entry and one over both appends."""
    store = _scratch(spark)
    stored = samples.stored_events(_table(spark, sf_dir, "events"))
    KS.append_entries(stored.where("event_row >= 600"), store, file_rows=1000)
    KS.append_entries(stored.where("event_row < 600"), store, file_rows=1000)
    parts = [
        KS.scan_store(spark, store, start, 1000).select(F.lit(start).alias("start"), "event_row", F.col("event_bytes").cast("string").alias("event_text"))
        for start in (100, 501, 1498)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query
def p1_placed_messages(spark, sf_dir):
    """Messages by the task that holds them: it is the topic partition of their key."""
    keyed = R.with_key(_records(spark, sf_dir, UNNUMBERED)).select("key")
    here = KP.placed(KP.with_key_partition(keyed, 16), 16)
    return here.groupBy(F.spark_partition_id().alias("task"), "key").agg(F.count("*").alias("messages"))


@_query
def r3_digest_differences(spark, sf_dir):
    """Keys that one of two feeds lacks; digests of each feed were kept in two runs.

    A feed is stored once: its digests and the comparison read the stored keys.
    """
    left, right = _sides(spark, sf_dir)
    sides = {"json": left.where("src_offset div 2 % 53 != 5"), "record": right}
    out = _scratch(spark)
    for name, feed in sides.items():
        feed.select("src_offset", "change_key").write.parquet(f"{out}/feeds/{name}")
        sides[name] = spark.read.schema("src_offset bigint, change_key string").parquet(f"{out}/feeds/{name}")
    for name, feed in sides.items():
        for step in (0, 1):
            KD.keep_digests(feed.where(F.expr("src_offset div 2 % 2") == step), out, step, name)
    kept = [KD.kept_digests(spark, out, name) for name in sides]
    return DG.differences(*sides.values(), *kept)


@_query
def a7_live_minutes(spark, sf_dir):
    """Fetch minutes of a stream of four batches, every tenth message a batch late, and how many came too late."""
    work = _scratch(spark)
    events = _table(spark, sf_dir, "events")
    total = events.agg((F.max("event_id") + 1).alias("n")).first().n
    batch = f"cast(least(3, event_id * 4 div {total} + if(event_id % 10 = 3, 1, 0)) as int)"
    fetched = samples.fetch_log(events).withColumn("_batch", F.expr(batch.replace("event_id", "(next_offset - 1)")))
    schema = fetched.drop("_batch").schema
    counts = MinuteCounts(f"{work}/counts")
    for number in range(4):
        fetched.where(F.col("_batch") == number).drop("_batch").write.parquet(f"{work}/in/batch={number}")
        # The next batch of files is there when the one before has been counted, also over a restart.
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{work}/in")
        counts.start(stream, f"{work}/checkpoint", availableNow=True).awaitTermination()
    return counts.counts(spark).drop("src_topic").withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@_query
def f2_routes_as_of(spark, sf_dir):
    """Topics under routes that change in the middle of each source partition, and of two once more."""
    log = _log(spark, sf_dir)
    lines = [(0, *line) for line in samples.ROUTE_LIST]
    lines += [(1, "orders_0", "mysql_z", "order_key", None), (1, "orders_4", "mysql_b", "row_no", None)]
    lines += [(2, "orders_1", "mysql_a", "order_key", None), (2, "orders_5", "mysql_z", "row_no", "quantity")]
    versions = [
        G.normalize_routes(samples.route_table(spark, [line[1:] for line in lines if line[0] == v])).withColumn("version", F.lit(v))
        for v in range(3)
    ]
    ends = log.groupBy("src_topic", "src_partition").agg(F.max("src_offset").alias("_last"))
    starts = [
        ends.where(rows).select(F.lit(v).alias("version"), "src_topic", "src_partition", F.expr(at).alias("from_offset"))
        for v, rows, at in ((1, "true", "_last div 2"), (2, "src_partition < 2", "_last * 3 div 4"))
    ]
    routes = G.VersionedRoutes(versions[0].unionByName(versions[1]).unionByName(versions[2]), starts[0].unionByName(starts[1]))
    return P.routed_envelopes(log, routes, UNNUMBERED).select(*PLACE, "topic")
