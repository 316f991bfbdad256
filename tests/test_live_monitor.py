"""Monitor rows of running queries against the batch form, and of one that fails."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from rowtide.operators import monitoring as M
from rowtide.operators.records import with_key
from rowtide.sources import topic_log as L
from rowtide.sources.wire import encode_envelopes
from rowtide.streaming.monitor import JobMonitor, live_offsets, live_rows, observed, offsets_of
from tests.builders import envelopes
from tests.test_ordering import random_log
from tests.test_streaming import expected, in_order, job, monitor, records


@pytest.fixture
def log():
    return sorted(random_log(11, size=60), key=lambda e: (e["src_offset"], e["src_partition"]))


def watch(spark, told):
    """Waits until the monitor has written the end of the query."""
    ended = time.time() + 60
    while told.running() and time.time() < ended:
        time.sleep(0.1)
    spark.streams.removeListener(told)


def log_of(spark, tmp_path, log):
    folder = str(tmp_path / "log")
    messages = encode_envelopes(envelopes(spark, *log)).withColumn("timestamp", F.timestamp_seconds("src_offset"))
    L.append_segments(messages, folder, segment_rows=10).collect()
    return folder


def test_totals_lag_and_sends_equal_the_batch_form(spark, tmp_path, log):
    folder, out = log_of(spark, tmp_path, log), str(tmp_path / "live")
    work = job(spark, tmp_path)
    told = JobMonitor(spark, work.job, out, lambda: L.latest_offsets(L.segments(folder)))
    spark.streams.addListener(told)
    checkpoint = str(tmp_path / "cp")
    stream = L.read_log(spark, folder, max_rows=len(log) // 3 + 2, checkpoint=checkpoint)
    query = work.start(stream, checkpoint, processingTime="0 seconds")
    query.processAllAvailable()
    query.stop()
    watch(spark, told)
    assert in_order(records(spark, work)) == in_order(expected(spark, log))
    rows = live_rows(spark, out).orderBy("batch_id").collect()
    fetch = [json.loads(r.content) for r in rows if r.id == M.MONITOR_IDS["FETCH"]]
    whole = L.read_log(spark, folder, streaming=False)
    n, size = whole.agg(F.count("*"), F.sum(F.octet_length("value"))).first()
    assert (sum(f["FETCH_NUM"] for f in fetch), sum(f["FETCH_SIZE"] for f in fetch)) == (n, size) and len(fetch) > 2
    lags = [f["DELAY_NUM"] for f in fetch]
    assert lags == sorted(lags, reverse=True) and lags[0] > 0 and lags[-1] == 0
    ends = live_offsets(spark, out).groupBy("src_partition").agg(F.max("next_offset").alias("n")).collect()
    assert {("changes", r.src_partition): r.n for r in ends} == L.latest_offsets(L.segments(folder))
    assert M.offset_lag(live_offsets(spark, out)).where("delay_num < 0").count() == 0
    # What was observed while writing is what a count over the written records gives.
    sends = [json.loads(text) for text in monitor(spark, work, M.MONITOR_IDS["PERSIS"])]
    written = with_key(spark.read.parquet(work.path("records")))
    batch = M.send_stats(written).first()
    assert sum(s["SEND_NUM"] for s in sends) == batch.send_num and sum(s["SEND_SIZE"] for s in sends) == batch.send_size


def test_a_failing_query_leaves_its_exception(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "live")
    spark.range(5).write.parquet(source)
    told = JobMonitor(spark, "failing", out)
    spark.streams.addListener(told)

    def fail(batch, number):
        raise ValueError("no room left")

    query = (
        observed(spark.readStream.schema("id long").parquet(source)).writeStream.foreachBatch(fail)
        .queryName("failing").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    with pytest.raises(Exception, match="no room left"):
        query.awaitTermination()
    watch(spark, told)
    rows = live_rows(spark, out).where(F.col("id") == M.MONITOR_IDS["EXCEPTION"]).collect()
    assert len(rows) == 1 and rows[0].jrdw_mark == "failing" and "no room left" in json.loads(rows[0].content)["EXCEPTION"]


def test_other_queries_are_left_alone(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "live")
    spark.range(5).write.parquet(source)
    told = JobMonitor(spark, "some job", out)
    spark.streams.addListener(told)
    stream = spark.readStream.schema("id long").parquet(source).writeStream.format("noop")
    stream.queryName("another").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    watch(spark, told)
    assert not (tmp_path / "live").exists()


def test_offsets_of_any_source():
    assert offsets_of('{"t": {"0": 5, "1": 6}}') == {("t", 0): 5, ("t", 1): 6}
    assert offsets_of('{"logOffset": 3}') == offsets_of("7") == offsets_of(None) == {}


def test_sends_are_counted_without_another_job(spark, tmp_path, log):
    """One write with an observation runs the stages of the write alone."""
    from pyspark.sql import Observation

    frame = spark.createDataFrame([("k", "v"), (None, "w"), ("l", "xyz")], "key string, value string")
    totals = Observation()
    spark.sparkContext.setJobGroup("observed", "")
    M.observed_sends(frame, totals).write.format("noop").mode("overwrite").save()
    seen = totals.get
    tracker = spark.sparkContext.statusTracker()
    assert seen == {"send_num": 2, "send_size": 4} and len(tracker.getJobIdsForGroup("observed")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
