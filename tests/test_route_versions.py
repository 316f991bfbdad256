"""Routes that change: every envelope is routed by the version at its place, also after restarts and in replays."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowtide import ConvertOptions, convert
from rowtide.operators.routing import VersionedRoutes, has_topic, with_route
from rowtide.sinks.routes import RouteLog
from rowtide.streaming.conversion import ConversionJob
from tests.builders import envelopes, routes
from tests.test_ordering import random_log

TABLES = (
    {"a": "ta", "b": "tb"},
    {"a": "new", "c": "tc"},
    {},
    {"b": "last"},
)
OPTIONS = ConvertOptions(on_missing_key="quarantine", widths=(8,), numbers=True)


def version(spark, number):
    lines = [(table, topic, "id", None) for table, topic in TABLES[number].items()]
    return routes(spark, *(lines or [("none", None, None, None)])).where("topic is not null")


def versioned(spark, *starts):
    rows = [version(spark, n).withColumn("version", F.lit(n)) for n in range(len(TABLES))]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    schema = "version int, src_topic string, src_partition int, from_offset bigint"
    return VersionedRoutes(every, spark.createDataFrame([*starts, (2, None, None, None)], schema))


def topics(frame):
    return sorted((r.src_partition, r.src_offset, r.topic) for r in has_topic(frame).select("src_partition", "src_offset", "topic").collect())


def by_loop(log, version_at, default=None):
    found = []
    for e in log:
        names = TABLES[version_at(e["src_partition"], e["src_offset"])]
        topic = names.get(e["header"]["table_name"]) or (None if names else default)
        if topic:
            found.append((e["src_partition"], e["src_offset"], topic))
    return sorted(found)


@pytest.mark.parametrize("default", [None, "rest"])
def test_each_envelope_has_the_version_at_its_place(spark, default):
    log = random_log(3, partitions=4, size=80)
    top = max(e["src_offset"] for e in log)
    # Partition 0 has all versions, 1 begins late in the second and skips one, 2 begins in the last, 3 is not named.
    starts = [(1, "changes", 0, 60), (2, "changes", 0, 90), (3, "changes", 0, 110), (1, "changes", 1, 80), (3, "changes", 1, 81),
              (3, "changes", 2, 100), (0, "changes", 0, 30)]

    def version_at(partition, offset):
        listed = sorted((o, v) for v, _, p, o in starts if p == partition)
        if not listed:
            return 3
        held = [v for o, v in listed if o <= offset]
        return held[-1] if held else max(0, listed[0][1] - 1)

    assert top > 120
    assert topics(with_route(envelopes(spark, *log), versioned(spark, *starts), default)) == by_loop(log, version_at, default)


def test_versions_that_begin_at_one_offset(spark):
    log = random_log(4, partitions=1, size=60)
    starts = [(1, "changes", 0, 50), (3, "changes", 0, 50)]
    got = topics(with_route(envelopes(spark, *log), versioned(spark, *starts)))
    assert got == by_loop(log, lambda _, offset: 3 if offset >= 50 else 0)


COLUMNS = ["src_partition", "src_offset", "row_no", "topic", "key", "mid", "opt"]


def in_order(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_a_job_keeps_what_changed_and_old_ranges_keep_their_routes(spark, tmp_path):
    log = sorted(random_log(7, size=60), key=lambda e: (e["src_offset"], e["src_partition"]))
    size = -(-len(log) // 4)
    parts = [log[i * size : (i + 1) * size] for i in range(4)]
    now = [0]
    work = ConversionJob(
        "job", lambda: version(spark, now[0]), str(tmp_path), lambda epoch: 1, OPTIONS
    )
    for epoch, part in enumerate(parts):
        now[0] = (0, 1, 1, 3)[epoch]
        # Each epoch runs in a job of its own, as after a restart.
        ConversionJob("job", work.routes, work.out, work.clock, OPTIONS).process(envelopes(spark, *part), epoch, "r")
    kept = RouteLog(work.path("route_log"))
    assert kept.read(spark).routes.select("version").distinct().count() == 3
    streamed = spark.read.parquet(work.path("records"))
    batch = convert(envelopes(spark, *log), kept.read(spark), 1, OPTIONS)
    assert in_order(streamed) == in_order(batch) and streamed.select("topic").distinct().count() > 2
    # A replay of the first epoch's range, long after, goes to the topics of then.
    again = convert(envelopes(spark, *parts[0]), kept.read(spark), 1, OPTIONS)
    then = convert(envelopes(spark, *parts[0]), version(spark, 0), 1, OPTIONS)
    assert in_order(again) == in_order(then)


def test_routes_that_change_while_an_epoch_is_down_leave_no_gap(spark, tmp_path):
    kept = RouteLog(str(tmp_path))
    positions = spark.createDataFrame([("changes", 0, 50)], "src_topic string, src_partition int, next_offset bigint")
    assert [kept.note(version(spark, n), p) for n, p in ((0, None), (0, positions), (1, positions), (2, positions), (2, positions))] == [0, 0, 1, 2, 2]
    log = random_log(9, partitions=1, size=60)
    got = topics(with_route(envelopes(spark, *log), kept.read(spark)))
    # Version 1 was noted by an epoch that never ended and version 2, without any route, at the same place.
    assert got and got == by_loop(log, lambda _, offset: 2 if offset >= 50 else 0)
