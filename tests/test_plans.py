"""Shape of the physical plans: what reaches the scan, what is shuffled, what is broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from rowtide import samples
from rowtide.operators.reconcile import missing_changes
from rowtide.sources.tables import from_positions, read_envelopes, scan_stored
from tests.conftest import TABLES


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "envelopes")
    Q._log(spark, TABLES).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(query(spark, TABLES)) for name, query in Q.registered().items()}


def test_no_query_crosses_rows(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_only_byte_codecs_run_python(plans):
    coded = {"s7_decode_envelopes", "s8_decode_records"}
    assert {name for name, text in plans.items() if "MapInArrow" in text} == coded


def test_range_scan_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "events")
    samples.stored_events(spark.read.parquet(f"{TABLES}/events.parquet")).write.parquet(path)
    text = plan(scan_stored(spark.read.parquet(path), 100, 50))
    assert "GreaterThanOrEqual(event_row,100), LessThan(event_row,150)" in text


def test_positions_reach_parquet(spark, stored_log):
    log = read_envelopes(spark, stored_log)
    half = log.groupBy("src_topic", "src_partition").agg(F.expr("max(src_offset) div 2").alias("next_offset"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    text = plan(from_positions(log, half))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in text.split("\n") if "PushedFilters" in line)
    assert "GreaterThanOrEqual(src_offset," in pushed and "EqualNullSafe(src_partition,0)" in pushed


@pytest.mark.parametrize("name", ["missing_changes", "null_audit"])
def test_audits_number_nothing(spark, stored_log, name):
    from rowtide import convert
    from rowtide.operators.audit import null_audit
    from rowtide.operators.reconcile import record_keys

    log = read_envelopes(spark, stored_log)

    def scans(options):
        records = convert(log, Q._routes(spark), 1, options)
        frame = null_audit(records) if name == "null_audit" else record_keys(records, Q.KEYS).select("change_key").distinct()
        return plan(frame).count("FileScan parquet")

    assert scans(Q.UNNUMBERED) == 2 and scans(Q.HELD) > 2


def test_counting_rows_reads_one_side_and_no_header_details(spark, stored_log):
    from rowtide.operators.monitoring import rows_per_topic
    from rowtide.plans.convert import routed_envelopes

    log = read_envelopes(spark, stored_log)
    text = plan(rows_per_topic(routed_envelopes(log, Q._routes(spark), Q.HELD)))
    assert "after:" not in text and "logfile_name" not in text and "tx_begin" not in text


def test_conversion_shuffles_images_once_and_no_cells(spark, stored_log):
    from rowtide import convert

    frame = convert(read_envelopes(spark, stored_log), Q._routes(spark), 1, Q.HELD)
    lines = plan(frame).split("\n")
    # What an exchange moves is what the project below it puts out.
    moved = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    assert sum("images#" in line.split("[", 1)[1] for line in moved) == 1
    assert not any("row_change#" in line for line in moved if "images#" not in line)
    assert not any("SinglePartition" in line for line in lines)


def test_difference_hashes_each_side_once(spark):
    left = spark.range(1000).selectExpr("cast(id as string) as change_key")
    right = spark.range(900).selectExpr("cast(id as string) as change_key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(missing_changes(left, right))
        assert text.count("hashpartitioning(change_key") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
