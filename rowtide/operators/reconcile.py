"""Compare two feeds of the same changes by their change keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_key(
    schema: Column, table: Column, fields: Column, operation: Column, keys: Sequence[str]
) -> Column:
    """``schema#table#`` + ``value#`` for each listed key present in ``fields`` + operation.

    Keys keep the listed order. A key that is present with a null value shows as ``null``.
    """
    parts = [
        F.when(
            F.map_contains_key(fields, F.lit(key)),
            F.concat(F.coalesce(fields[key], F.lit("null")), F.lit("#")),
        ).otherwise(F.lit(""))
        for key in keys
    ]
    return F.concat(schema, F.lit("#"), table, F.lit("#"), *parts, operation)


def record_keys(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``change_key`` to records."""
    fields = F.coalesce("cur", F.create_map().cast("map<string,string>"))
    return records.withColumn(
        "change_key", change_key(F.col("db"), F.col("tab"), fields, F.col("opt"), keys)
    )


def json_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``change_key`` to decoded JSON changes (columns of ``schemas.JSON_CHANGE``)."""
    fields = F.coalesce("fields", F.create_map().cast("map<string,string>"))
    return changes.withColumn(
        "change_key",
        change_key(F.col("schema"), F.col("table"), fields, F.col("operation"), keys),
    )


def missing_changes(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct change keys of ``expected`` that ``found`` does not have.

    Both sides are made distinct first, with map-side combine, so a key that holds a large share
    of either feed is one row per task before the shuffle. Both are then hashed on the key alone
    and the anti join needs no further shuffle.
    """
    left = expected.select("change_key").distinct()
    right = found.select("change_key").distinct()
    return left.join(right, "change_key", "left_anti")


def missing_count(expected: DataFrame, found: DataFrame) -> DataFrame:
    return missing_changes(expected, found).agg(F.count("*").alias("missing"))


def captured(feed: DataFrame, time: str, start: Column, duration: Column) -> DataFrame:
    """Messages of a feed inside ``[start, start + duration)``."""
    return feed.where((F.col(time) >= start) & (F.col(time) < start + duration))


def capture_counts(
    left: DataFrame, right: DataFrame, time: str, start: Column, duration: Column
) -> DataFrame:
    """Message counts of both feeds over the same capture, one row per feed."""
    counts = [
        captured(feed, time, start, duration).agg(F.count("*").alias("messages")).select(
            F.lit(name).alias("feed"), "messages"
        )
        for name, feed in (("json", left), ("record", right))
    ]
    return counts[0].unionByName(counts[1])
