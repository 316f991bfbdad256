"""Visibility of epochs, compaction, the sorted store and placement by partition."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import rowtide.streaming.conversion as conversion
from rowtide.schemas import POSITIONS
from rowtide.sinks import commits as C
from rowtide.sinks import store as S
from rowtide.sinks import topics as K
from tests.builders import envelopes
from tests.test_ordering import random_log
from tests.test_streaming import job

ROWS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("n", T.LongType())])


def write_epochs(spark, out, run, epochs, table="records"):
    for epoch in epochs:
        frame = spark.createDataFrame([(f"t{epoch % 3}", epoch * 10 + k) for k in range(3)], ROWS)
        frame.coalesce(1).write.mode("overwrite").parquet(f"{out}/{table}/run={run}/epoch={epoch}")


def rows_of(frame):
    return sorted((r.run, r.epoch, r.topic, r.n) for r in frame.collect())


def test_only_published_epochs_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    assert rows_of(C.read_committed(spark, out, "records", ROWS)) == []
    write_epochs(spark, out, "a", range(3))
    assert C.publish(out, "a", 0, ["records"]) and C.publish(out, "a", 1, ["records"])
    assert not C.publish(out, "a", 1, ["records"])
    seen = rows_of(C.read_committed(spark, out, "records", ROWS))
    assert {(run, epoch) for run, epoch, *_ in seen} == {("a", 0), ("a", 1)} and len(seen) == 6
    everything = spark.read.parquet(f"{out}/records")
    assert C.only_committed(everything, out).count() == 6


def test_compaction_keeps_the_rows_through_every_step(spark, tmp_path, monkeypatch):
    out, want = str(tmp_path / "out"), None
    for step in range(7):
        low = step * 4
        write_epochs(spark, out, "a", range(low, low + 4))
        for epoch in range(low, low + 4):
            C.publish(out, "a", epoch, ["records"])
        want = rows_of(C.read_committed(spark, out, "records", ROWS))
        assert len(want) == (low + 4) * 3
        if step == 3:  # dies when the files are written and the snapshot is not
            with monkeypatch.context() as broken:
                broken.setattr(C, "write_text", lambda *_: (_ for _ in ()).throw(OSError("gone")))
                with pytest.raises(OSError):
                    C.compact(spark, out, "records", ROWS, ["n"], ["topic"], fanout=3)
            assert rows_of(C.read_committed(spark, out, "records", ROWS)) == want
        made = C.compact(spark, out, "records", ROWS, ["n"], ["topic"], fanout=3)
        assert rows_of(C.read_committed(spark, out, "records", ROWS)) == want
        assert max(Counter(level for level, _ in made.folders).values()) < 3
    assert made.until == {"a": 27} and len(made.folders) <= 4
    assert C.compact(spark, out, "records", ROWS, ["n"], ["topic"]) == made
    write_epochs(spark, out, "b", range(1))
    C.publish(out, "b", 0, ["records"])
    want = rows_of(C.read_committed(spark, out, "records", ROWS))
    gone = C.vacuum(out, "records")
    assert len([g for g in gone if g.startswith("run=a")]) == 24 and any(g.startswith("_merged") for g in gone)
    assert rows_of(C.read_committed(spark, out, "records", ROWS)) == want


def test_many_epochs_become_few_sorted_files(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(1500).select(F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("topic"), F.col("id").alias("n"))
    rows = rows.withColumn("run", F.lit("a")).withColumn("epoch", F.floor(F.col("n") / 5))
    rows.coalesce(1).write.partitionBy("run", "epoch").parquet(f"{out}/records")
    for epoch in range(300):
        C.publish(out, "a", epoch, ["records"])
    made = C.compact(spark, out, "records", ROWS, ["n"], ["topic"])
    merged = C.read_committed(spark, out, "records", ROWS)
    assert merged.count() == 1500 and len(merged.inputFiles()) <= 8 and len(made.folders) == 1
    per_file = merged.groupBy(F.input_file_name().alias("f"), "topic").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    stretches = sorted((r.topic, r.low, r.high) for r in per_file.collect())
    assert all(a[2] < b[1] for a, b in zip(stretches, stretches[1:], strict=False) if a[0] == b[0])


def test_a_killed_writer_leaves_nothing_visible_and_a_replay_publishes_once(spark, tmp_path, monkeypatch):
    log = sorted(random_log(11, size=30), key=lambda e: (e["src_offset"], e["src_partition"]))
    half = len(log) // 2
    work = job(spark, tmp_path)
    first, second = envelopes(spark, *log[:half]), envelopes(spark, *log[half:])
    work.process(first, 0, "r")
    write = conversion.ConversionJob._write

    def dies(self, df, table, epoch, run):
        if table == "positions":
            raise OSError("killed")
        write(self, df, table, epoch, run)

    with monkeypatch.context() as broken:
        broken.setattr(conversion.ConversionJob, "_write", dies)
        with pytest.raises(OSError):
            work.process(second, 1, "r")
    assert C.published(work.out) == [("r", 0)]
    positions = C.read_committed(spark, work.out, "positions", POSITIONS)
    assert {r.epoch for r in positions.collect()} == {0}
    work.process(second, 1, "r")
    assert C.published(work.out) == [("r", 0), ("r", 1)]
    before = sorted(p.name for p in (tmp_path / "out").rglob("*.parquet"))
    work.process(second, 1, "r")
    assert sorted(p.name for p in (tmp_path / "out").rglob("*.parquet")) == before


def entries(spark, low, high, empty=()):
    bytes_ = F.when(~F.col("id").isin([-1, *empty]), F.col("id").cast("string").cast("binary"))
    return spark.range(low, high).select(F.col("id").alias("event_row"), bytes_.alias("event_bytes"))


def test_scans_open_only_files_whose_range_they_meet(spark, tmp_path):
    store = str(tmp_path / "store")
    assert S.scan_store(spark, store, 0).count() == 0
    S.append_entries(entries(spark, 0, 4000, empty=[2500]), store, file_rows=500)
    files = sorted(p.name for p in (tmp_path / "store").rglob("*.parquet"))
    S.append_entries(entries(spark, 4000, 5000, empty=[4100]), store, file_rows=500)
    assert set(files) < {p.name for p in (tmp_path / "store").rglob("*.parquet")}
    whole = S.zones(store)
    assert sum(z.rows for z in whole) == 5000 and sum(z.empty for z in whole) == 2
    for start, span, end in ((0, 100, 100), (700, 400, 1100), (2400, 1000, 2500), (3900, 10_000, 4100), (2500, 10, 2500)):
        scan = S.scan_store(spark, store, start, span)
        assert sorted(r.event_row for r in scan.collect()) == list(range(start, end))
        met = [z for z in whole if z.first < end and z.last >= start]
        assert len(scan.inputFiles()) == len(met) <= 3
    (tmp_path / "store" / "append-unfinished").mkdir()
    entries(spark, 0, 9).write.parquet(str(tmp_path / "store" / "append-half"))
    assert S.scan_store(spark, store, 0, 100).count() == 100


@pytest.mark.parametrize("hot", [False, True])
def test_tasks_and_files_are_topic_partitions(spark, tmp_path, hot):
    keys = spark.range(500).select(F.concat(F.lit("order."), (F.lit(7) if hot else F.col("id")).cast("string")).alias("key"), F.col("id").alias("n"))
    messages = K.with_numeric_partition(keys, 12).where("partition != 3")
    here = K.placed(messages, 12).withColumn("task", F.spark_partition_id())
    assert here.where("task != partition").count() == 0 and here.count() == messages.count()
    assert K.placed(messages, 12).rdd.getNumPartitions() == 12
    out = str(tmp_path / "placed")
    K.write_placed(messages, out, 12)
    per_file = spark.read.parquet(out).groupBy(F.input_file_name()).agg(F.count_distinct("partition").alias("p"))
    assert per_file.where("p != 1").count() == 0 and per_file.count() == messages.select("partition").distinct().count()
    for part in (tmp_path / "placed").glob("partition=*/*.parquet"):
        keys_ = [r.key for r in spark.read.parquet(str(part)).collect()]
        assert keys_ == sorted(keys_)
