"""Monitoring where minutes and flushes lie far apart, and the hash of keys."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rowtide.operators.monitoring import offset_lag, zero_fill
from rowtide.sinks.topics import with_key_partition

START = datetime(2024, 1, 1)


def fetched(spark, *rows):
    """(minute, next offset, latest offset) of one source partition."""
    schema = "fetch_ts timestamp_ntz, src_topic string, src_partition int, next_offset long, latest_offset long"
    return spark.createDataFrame([(START + timedelta(minutes=m), "t", 0, n, last) for m, n, last in rows], schema)


def test_a_far_off_minute_is_reached_step_by_step(spark):
    far = 5_000_000
    lag = offset_lag(fetched(spark, (0, 4, 10), (2, 0, 12), (far, 8, 20)), widths=(1000,))
    assert lag.count() == far + 1
    rows = {r.minute: (r.now_offset, r.last_offset) for r in lag.where(F.col("minute") < START + timedelta(minutes=4)).collect()}
    # An offset of 0 is not known: the one before it still holds.
    assert [rows[START + timedelta(minutes=m)] for m in range(4)] == [(4, 10), (4, 10), (4, 12), (4, 12)]
    assert lag.orderBy(F.desc("minute")).first().delay_num == 12


def test_an_unknown_offset_starts_at_the_start_position(spark):
    starts = spark.createDataFrame([("t", 0, 3)], "src_topic string, src_partition int, start_offset long")
    row = offset_lag(fetched(spark, (0, 0, 9)), starts).first()
    assert (row.now_offset, row.delay_num) == (3, 6)


def test_silent_topics_report_zero_over_many_flushes(spark):
    rows = spark.createDataFrame([("a", 3, 1), ("a", 70_000, 2), ("b", 69_999, 5)], "topic string, flush long, row_num long")
    filled = zero_fill(rows, "flush")
    counts = {r.topic: (r.n, r.s) for r in filled.groupBy("topic").agg(F.count("*").alias("n"), F.sum("row_num").alias("s")).collect()}
    assert counts == {"a": (69_998, 3), "b": (2, 5)}


def jvm_hash(text):
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (31 * h + int.from_bytes(units[i : i + 2], "big")) % (1 << 32)
    return h - (1 << 32) if h >> 31 else h


def test_keys_go_where_the_producers_hash_says(spark):
    keys = ["", "a", "order_1", "polygenelubricants", "é\u0001x", "emoji 😀 end", "z" * 100]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    for r in with_key_partition(frame, 7).collect():
        h = jvm_hash(r.key)
        assert r.partition == (0 if h == -(1 << 31) else abs(h)) % 7, r.key
    assert jvm_hash("polygenelubricants") == -(1 << 31)
