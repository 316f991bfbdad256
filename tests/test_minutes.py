"""Counts per minute of a stream, with late rows apart, add up to the batch counts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rowtide.operators.monitoring import fetch_per_minute
from rowtide.streaming.minutes import MinuteCounts

START = datetime(2024, 1, 1)
SCHEMA = "src_topic string, src_partition int, fetch_ts timestamp_ntz, n_bytes long"


def fetched(spark, *rows):
    """(source partition, minute, bytes)."""
    return spark.createDataFrame([("t", p, START + timedelta(minutes=m), n) for p, m, n in rows], SCHEMA)


def summed(frame, *extra):
    return sorted((r.src_partition, r.minute, r.fetch_num, r.fetch_size, *[r[e] for e in extra]) for r in frame.collect())


# Minutes, with rows of partition 0 up to twenty minutes late; partition 1 lags behind without being late.
EPOCHS = [
    [(0, 0.0, 1), (0, 0.5, 2), (0, 5, 3), (1, 0.2, 4)],
    [(0, 20, 5), (0, 5.1, 6), (1, 1, 7)],
    [(0, 9.0, 8), (0, 8.99, 9), (0, 5.2, 10), (0, 9.5, 11), (1, 0.9, 12), (1, 500_000, 1)],
    [(0, 21, 13), (1, 4, 14), (1, 499_995, 15)],
]


def test_late_rows_are_counted_apart_and_nothing_is_lost(spark, tmp_path):
    work = MinuteCounts(str(tmp_path))
    assert work.counts(spark) is None
    for epoch, rows in enumerate(EPOCHS):
        work.process(fetched(spark, *rows), epoch, "r")
        every = fetched(spark, *[row for part in EPOCHS[: epoch + 1] for row in part])
        assert summed(work.counts(spark)) == summed(fetch_per_minute(every))
        assert work.open_minutes(spark).groupBy("src_partition").count().agg(F.max("count")).first()[0] <= 12
    late = {(r.src_partition, r.minute): r.late_num for r in work.counts(spark).where("late_num > 0").collect()}
    # The watermark of partition 0 was at minute 10 in the third epoch: minute 8 has ended, minute 9 just ends.
    at = lambda m: START + timedelta(minutes=m)
    assert late == {(0, at(5)): 1, (0, at(8)): 1, (0, at(9)): 2, (1, at(4)): 1}


def test_a_replay_counts_nothing_twice(spark, tmp_path):
    work = MinuteCounts(str(tmp_path))
    for epoch, rows in ((0, EPOCHS[0]), (1, EPOCHS[1]), (1, EPOCHS[1]), (0, EPOCHS[0]), (2, EPOCHS[2])):
        work.process(fetched(spark, *rows), epoch, "r")
    every = fetched(spark, *[row for part in EPOCHS[:3] for row in part])
    assert summed(work.counts(spark)) == summed(fetch_per_minute(every))


def test_an_epoch_that_died_before_it_was_published_starts_again(spark, tmp_path, monkeypatch):
    from rowtide.streaming import minutes

    work = MinuteCounts(str(tmp_path))
    work.process(fetched(spark, *EPOCHS[0]), 0, "r")

    def dies(*_):
        raise OSError("gone")

    monkeypatch.setattr(minutes, "publish", dies)
    try:
        work.process(fetched(spark, *EPOCHS[1]), 1, "r")
    except OSError:
        pass
    monkeypatch.undo()
    assert summed(work.counts(spark)) == summed(fetch_per_minute(fetched(spark, *EPOCHS[0])))
    work.process(fetched(spark, *EPOCHS[1]), 1, "r")
    assert summed(work.counts(spark)) == summed(fetch_per_minute(fetched(spark, *EPOCHS[0], *EPOCHS[1])))


def test_as_a_stream_over_a_restart(spark, tmp_path):
    source, work = tmp_path / "in", MinuteCounts(str(tmp_path / "out"), "10 minutes")
    for half in (EPOCHS[:2], EPOCHS[2:]):
        for rows in half:
            fetched(spark, *rows).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
        work.start(stream, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    every = fetched(spark, *[row for part in EPOCHS for row in part])
    assert summed(work.counts(spark)) == summed(fetch_per_minute(every))
    assert work.counts(spark).agg(F.sum("late_num")).first()[0] == 5
