"""Comparing feeds by digests gives what comparing all their keys gives."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rowtide.operators import digests as D
from rowtide.operators.reconcile import missing_changes
from rowtide.sinks.digests import keep_digests, kept_digests


def feed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "change_key string")


def both_ways(left, right):
    return sorted(
        [(r.change_key or "", "right") for r in missing_changes(left, right).collect()]
        + [(r.change_key or "", "left") for r in missing_changes(right, left).collect()]
    )


def told(left, right, *digests):
    found = D.differences(left, right, *(digests or (D.key_digests(left), D.key_digests(right))))
    return sorted((r.change_key or "", r.missing_in) for r in found.collect())


def test_random_feeds(spark):
    pick = random.Random(5)
    for share in (0.0, 0.1, 1.0):
        keys = [f"s#t#{i}#INSERT" for i in range(200)]
        left = [k for k in keys if pick.random() >= share / 2] + pick.choices(keys[:3], k=40)
        right = [k for k in keys if pick.random() >= share / 2]
        pair = feed(spark, left), feed(spark, right)
        assert told(*pair) == both_ways(*pair)


def test_null_and_empty_keys_and_empty_feeds(spark):
    sides = ([None, None, "", "a"], [None, "a", "b"], ["a"], [])
    for left in sides:
        for right in sides:
            pair = feed(spark, left), feed(spark, right)
            assert told(*pair) == both_ways(*pair), (left, right)


def test_steps_add_up_and_are_kept_once(spark, tmp_path):
    left = feed(spark, [f"k{i}" for i in range(500)])
    right = left.where("change_key not in ('k7', 'k400')").unionByName(feed(spark, ["x"]))
    out = str(tmp_path)
    for name, rows in (("json", left), ("record", right)):
        parts = [rows.where(F.crc32("change_key") % 3 == i) for i in range(3)]
        for step in (0, 1, 1, 2):
            keep_digests(parts[step], out, step, name)
    kept = [kept_digests(spark, out, name) for name in ("json", "record")]
    assert sorted(kept[0].collect()) == sorted(D.key_digests(left).select(kept[0].columns).collect())
    assert told(left, right, *kept) == [("k400", "right"), ("k7", "right"), ("x", "left")]


def test_only_differing_buckets_move(spark):
    left = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("change_key"))
    for lost in (0, 1, 10, 100):
        right = left.where(F.crc32("change_key") % 20_000 >= lost)
        missing = 20_000 - right.count()
        buckets = D.differing_buckets(D.key_digests(left), D.key_digests(right))
        assert buckets.count() <= missing
        moved = D.in_buckets(left, buckets).count()
        assert missing <= moved <= 5 * missing  # 20,000 keys in 65,536 buckets
    # Every other key again: the sums of a level are not what a set would have, so nothing is taken as equal.
    twice = left.unionByName(left.where(F.crc32("change_key") % 2 == 0))
    assert D.differences(left, twice, D.key_digests(left), D.key_digests(twice)).isEmpty()


def test_feeds_are_filtered_before_they_are_shuffled(spark):
    left = feed(spark, ["a", "b"])
    right = feed(spark, ["a"])
    frame = D.differences(left, right, D.key_digests(left), D.key_digests(right))
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "Cartesian" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_query_converts_a_feed_once(spark):
    """Digests and comparison read the stored feeds; the tables of the log are not read again."""
    from checks.queries import r3_digest_differences

    read = r3_digest_differences(spark, "/root/testdata/sf0.001").inputFiles()
    assert read and not [path for path in read if "orders.parquet" in path]
