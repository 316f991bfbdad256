"""The segment log: ranges and limits by hand, and the stream against a batch over restarts."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowtide.sources import topic_log as L
from rowtide.sources.kafka import starting_offsets

A, B = ("changes", 0), ("changes", 1)


def segment(first, last, size=1000):
    return L.Segment(first, last, f"{first}", size)


def test_offsets_out_of_range_go_to_the_end_they_are_beyond():
    found = {A: [segment(100, 200), segment(200, 260)], B: [segment(0, 10)]}
    assert L.clamped(found, {A: 5, B: 99}) == {A: 100, B: 10}
    assert L.clamped(found, {A: 150}) == {A: 150, B: 0}
    assert L.clamped(found, {("gone", 0): 3}) == {A: 100, B: 0}


def test_limits_share_what_waits():
    found = {A: [segment(0, 100, 1000), segment(100, 400, 600)], B: [segment(0, 100, 100)]}
    assert L.limited(found, {}, 50, None) == {A: 40, B: 10}
    assert L.limited(found, {A: 400, B: 99}, 1, None) == {A: 400, B: 100}
    assert L.limited(found, {}, None, 10_000) == {A: 400, B: 100}
    by_bytes = L.limited(found, {}, None, 850)
    assert by_bytes == {A: 80, B: 50}
    assert L.limited(found, {}, None, 1) == {A: 1, B: 1}
    assert L.limited(found, {}, 1000, 1360) == {A: 240, B: 80}


def test_tasks_are_cut_at_segments():
    found = {A: [segment(0, 100), segment(100, 200), segment(200, 300), segment(350, 400)]}
    cut = [(r.first, r.next, r.paths) for r in L.ranges(found, {A: 50}, {A: 380}, 200)]
    assert cut == [(50, 200, ["0", "100"]), (200, 380, ["200", "350"])]
    assert L.ranges(found, {A: 300}, {A: 300}, 200) == []


def messages(spark, low, high):
    """Partition 1 has every third offset only."""
    rows = spark.range(low, high).select(
        F.lit("chan/ges").alias("src_topic"), F.lit(0).alias("src_partition"), F.col("id").alias("src_offset"),
        F.timestamp_seconds("id").alias("timestamp"), F.concat(F.lit("m"), F.col("id").cast("string")).cast("binary").alias("value"),
    )
    return rows.unionByName(rows.where("src_offset % 3 = 0").withColumn("src_partition", F.lit(1)))


def run(spark, log, out, checkpoint, **options):
    """Batches of a query that reads all that is there, and stops."""
    query = (
        L.read_log(spark, log, checkpoint=checkpoint, **options)
        .writeStream.foreachBatch(lambda b, n: b.withColumn("batch", F.lit(n)).write.mode("append").parquet(out))
        .option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [p["sources"][0]["endOffset"] for p in query.recentProgress]


def places(frame):
    return sorted((r.src_partition, r.src_offset, bytes(r.value)) for r in frame.collect())


@pytest.fixture
def log(spark, tmp_path):
    folder = str(tmp_path / "log")
    made = L.append_segments(messages(spark, 0, 1000), folder, segment_rows=100).collect()
    assert len(made) == 20 and sum(r.messages for r in made) == 1000 + 334
    return folder


def test_stream_equals_batch_over_a_restart(spark, tmp_path, log):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    run(spark, log, out, checkpoint, max_rows=700)
    first = spark.read.parquet(out)
    assert places(first) == places(messages(spark, 0, 1000)) and first.select("batch").distinct().count() >= 3
    L.append_segments(messages(spark, 1000, 1500), log, segment_rows=100).collect()
    run(spark, log, out, checkpoint, max_rows=100)
    assert places(spark.read.parquet(out)) == places(messages(spark, 0, 1500))
    assert places(L.read_log(spark, log, streaming=False)) == places(messages(spark, 0, 1500))
    per_batch = spark.read.parquet(out).groupBy("batch").count().collect()
    assert max(r["count"] for r in per_batch if r.batch > 3) <= 101


def test_positions_start_a_query_and_are_clamped(spark, tmp_path, log):
    for old in sorted(Path(log).glob("chan%2Fges/0/*.parquet"))[:3]:
        old.unlink()  # retention
    positions = spark.createDataFrame(
        [("chan/ges", 0, 120), ("chan/ges", 1, 5000)], "src_topic string, src_partition int, next_offset long"
    )
    starting = starting_offsets(positions)
    assert json.loads(starting)["chan/ges"] == {"0": 120, "1": 5000}
    rows = L.read_log(spark, log, streaming=False, starting=starting)
    assert places(rows) == places(messages(spark, 300, 1000).where("src_partition = 0"))
    assert {r.latest_offset for r in rows.select("latest_offset").distinct().collect()} == {1000}
    out = str(tmp_path / "out")
    run(spark, log, out, str(tmp_path / "cp"), starting=starting, max_bytes=2000)
    assert places(spark.read.parquet(out)) == places(rows)
    assert places(L.read_log(spark, log, streaming=False, starting="latest")) == []


def test_nothing_there(spark, tmp_path):
    empty = str(tmp_path / "none")
    assert L.read_log(spark, empty, streaming=False).count() == 0
    assert L.append_segments(messages(spark, 0, 0), empty).count() == 0
    assert L.planned_offsets(str(tmp_path / "cp")) is None


def test_a_partition_that_appears_later_is_read_from_its_start(spark, tmp_path):
    log, out, cp = (str(tmp_path / n) for n in ("log", "out", "cp"))
    L.append_segments(messages(spark, 0, 50).where("src_partition = 0"), log).collect()
    run(spark, log, out, cp)
    L.append_segments(messages(spark, 0, 50).where("src_partition = 1"), log).collect()
    run(spark, log, out, cp)
    assert places(spark.read.parquet(out)) == places(messages(spark, 0, 50))
