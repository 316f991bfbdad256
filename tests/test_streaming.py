"""The streaming job gives the records of the batch job, also over restarts and repeats."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rowtide import ConvertOptions, convert
from rowtide.operators.monitoring import MONITOR_IDS, SEND_MEASURES
from rowtide.schemas import ENVELOPE
from rowtide.sinks.tables import position_history, published_positions
from rowtide.sources.tables import stream_envelopes
from rowtide.sources.wire import encode_envelopes
from rowtide.streaming.capture import live_missing_changes
from rowtide.streaming.conversion import ConversionJob
from tests.builders import envelopes
from tests.test_ordering import random_log, spark_routes

COLUMNS = ["src_partition", "src_offset", "row_no", "topic", "key", "mid", "opt", "src", "cur"]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[:3])


def job(spark, tmp_path, **options):
    return ConversionJob(
        job="job_1", routes=spark_routes(spark), out=str(tmp_path / "out"),
        clock=lambda epoch: 1_000_000 + epoch * 60_000,
        options=ConvertOptions(on_missing_key="quarantine", widths=(8,), **options),
    )


@pytest.fixture
def log():
    return sorted(random_log(11, size=60), key=lambda e: (e["src_offset"], e["src_partition"]))


def write_files(spark, log, folder, count):
    size = -(-len(log) // count)
    for i in range(count):
        part = envelopes(spark, *log[i * size:(i + 1) * size])
        part.coalesce(1).write.mode("append").parquet(str(folder))


def records(spark, work):
    return spark.read.parquet(work.path("records")).select(*COLUMNS).collect()


def expected(spark, log):
    options = ConvertOptions(on_missing_key="quarantine")
    return convert(envelopes(spark, *log), spark_routes(spark), 1, options).select(*COLUMNS).collect()


def test_stream_equals_batch_over_a_restart(spark, tmp_path, log):
    source = tmp_path / "in"
    work = job(spark, tmp_path)
    half = len(log) // 2
    write_files(spark, log[:half], source, 2)
    for part in (None, log[half:]):
        if part:
            write_files(spark, part, source, 2)
        stream = stream_envelopes(spark, str(source), files_per_trigger=1)
        query = work.start(stream, str(tmp_path / "checkpoint"), availableNow=True)
        query.awaitTermination()
    assert in_order(records(spark, work)) == in_order(expected(spark, log))
    positions = spark.read.parquet(work.path("positions"))
    last = positions.groupBy("src_partition").agg(F.max("next_offset").alias("n")).collect()
    tops = {p: max(e["src_offset"] for e in log if e["src_partition"] == p) + 1 for p in (0, 1)}
    assert {r.src_partition: r.n for r in last} == tops
    assert published_positions(positions).count() <= positions.count()
    assert position_history(positions).select("time").distinct().count() == 4


def test_a_new_checkpoint_goes_on_and_keeps_what_was_written(spark, tmp_path, log):
    source = tmp_path / "in"
    work = job(spark, tmp_path)
    half = len(log) // 2
    write_files(spark, log[:half], source, 2)
    for part, checkpoint in ((None, "first"), (log[half:], "second")):
        if part:
            write_files(spark, part, source, 2)
        stream = stream_envelopes(spark, str(source), files_per_trigger=1)
        work.start(stream, str(tmp_path / checkpoint), availableNow=True).awaitTermination()
    positions = spark.read.parquet(work.path("positions"))
    assert positions.select("run").distinct().count() == 2
    assert in_order(records(spark, work)) == in_order(expected(spark, log))
    assert positions.agg(F.max("step")).first()[0] == positions.select("run", "epoch").distinct().count() - 1


def test_bad_bytes_are_kept_apart_and_the_rest_converted(spark, tmp_path, log):
    messages = encode_envelopes(envelopes(spark, *log))
    damaged = F.when(F.col("src_offset") % 5 == 0, F.lit(b"\xff\xff\x01")).otherwise(F.col("value"))
    raw = messages.withColumn("value", damaged)
    work = job(spark, tmp_path)
    for epoch, part in enumerate((raw.where("src_offset < 30"), raw.where("src_offset >= 30"))):
        work.process(part, epoch)
    good = [e for e in log if e["src_offset"] % 5]
    assert in_order(records(spark, work)) == in_order(expected(spark, good))
    bad = spark.read.parquet(work.path("undecodable"))
    assert bad.count() + len(good) == len(log) and bad.where("decode_error is null").count() == 0
    told = monitor(spark, work, MONITOR_IDS["EXCEPTION"])
    assert len(told) == bad.count() and all("EXCEPTION" in text for text in told)
    tops = {r.src_partition: r.n for r in spark.read.parquet(work.path("positions")).groupBy("src_partition").agg(
        F.max("next_offset").alias("n")).collect()}
    assert tops == {p: max(e["src_offset"] for e in log if e["src_partition"] == p) + 1 for p in (0, 1)}
    with pytest.raises(Exception, match="Error|Exception"):
        ConversionJob("strict", work.routes, str(tmp_path / "strict"), work.clock, work.options, strict=True).process(raw, 0)


def test_topics_keep_their_own_order(spark, tmp_path, log):
    twice = [*log, *({**e, "src_topic": "other"} for e in log)]
    work = job(spark, tmp_path)
    work.process(envelopes(spark, *twice), 0)
    rows = spark.read.parquet(work.path("records"))
    for topic in ("changes", "other"):
        own = rows.where(F.col("src_topic") == topic).select(*COLUMNS).collect()
        assert in_order(own) == in_order(expected(spark, log))


def monitor(spark, work, kind):
    texts = [json.loads(r.value) for r in spark.read.parquet(work.path("monitor")).collect()]
    return [t["content"] for t in texts if t["id"] == kind]


def test_a_repeated_epoch_changes_nothing(spark, tmp_path, log):
    work = job(spark, tmp_path)
    half = len(log) // 2
    first, second = envelopes(spark, *log[:half]), envelopes(spark, *log[half:])
    work.process(first, 0)
    work.process(second, 1)
    once = in_order(records(spark, work))
    work.process(second, 1)
    assert in_order(records(spark, work)) == once == in_order(expected(spark, log))


def test_an_empty_batch_keeps_the_position(spark, tmp_path, log):
    work = job(spark, tmp_path)
    work.process(envelopes(spark, *log), 0)
    work.process(spark.createDataFrame([], ENVELOPE), 1)
    rows = spark.read.parquet(work.path("positions"))
    keep = ["src_partition", "next_offset", "last_batch_id", "last_in_id", "batch_id", "in_id", "mid"]
    by_epoch = [
        sorted(tuple(r) for r in rows.where(f"epoch = {e}").select(*keep).collect()) for e in (0, 1)
    ]
    assert by_epoch[0] == by_epoch[1] and len(by_epoch[0]) == 2
    assert rows.where("epoch = 1 and sent > 0").count() == 0


def test_monitor_rows_of_an_epoch(spark, tmp_path, log):
    work = job(spark, tmp_path)
    work.process(envelopes(spark, *log), 0)
    one = {kind: monitor(spark, work, number) for kind, number in MONITOR_IDS.items()}
    assert {k for k, v in one.items() if v} == {"TOPIC_ROWS", "TOPIC_DELAY", "PERSIS", "FETCH", "IP"}
    sent = json.loads(one["PERSIS"][0])
    assert list(sent) == sorted(SEND_MEASURES) and sent["SEND_NUM"] > 0 and sent["SEND_SIZE"] > 0
    fetch = json.loads(one["FETCH"][0])
    assert fetch == {"DELAY_NUM": 0, "FETCH_NUM": len(log), "FETCH_SIZE": 0}
    assert json.loads(one["IP"][0]) == {"IP": "10.0.0.9"}
    topics = json.loads(one["TOPIC_ROWS"][0])
    assert set(topics) == {r.topic for r in work.routes.collect() if r.topic} and sum(topics.values()) == sent["SEND_NUM"]


def test_live_missing_changes(spark, tmp_path):
    def stream(name, keys):
        folder = str(tmp_path / name)
        rows = [(k, t) for k, t in keys]
        frame = spark.createDataFrame(rows, "change_key string, t long").select(
            "change_key", F.timestamp_seconds("t").alias("event_time")
        )
        frame.coalesce(1).write.parquet(folder)
        late = spark.createDataFrame([("end", 100_000)], "change_key string, t long").select(
            "change_key", F.timestamp_seconds("t").alias("event_time")
        )
        late.coalesce(1).write.mode("append").parquet(folder)
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    left = stream("json", [("a", 10), ("b", 20), ("c", 30)])
    right = stream("record", [("a", 12), ("c", 900)])
    query = (
        live_missing_changes(left, right, timesize="5 minutes")
        .writeStream.format("memory").queryName("missing")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.change_key for r in spark.table("missing").collect()) == ["b", "c"]
