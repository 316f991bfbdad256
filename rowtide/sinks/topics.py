"""Keyed messages for topics, and the partitioners of their producers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import numeric_suffix_partition
from rowtide.sources.wire import encode_records


def keyed_messages(records: DataFrame) -> DataFrame:
    """Records as (topic, key, value): the columns Spark's Kafka sink takes."""
    return encode_records(records).select("topic", "key", "value")


def flush_trigger(seconds: float = 1.0) -> dict[str, str]:
    """Trigger of ``writeStream``: a flush at least every second.

    The row and byte limits of a flush become the source's limit per trigger, see
    ``sources.kafka.source_options``.
    """
    return {"processingTime": f"{seconds:g} seconds"}


def text_hash(text: Column) -> Column:
    """The signed 32-bit hash of a text that JVM producers take: h = 31 * h + code unit."""
    units = lambda point: F.when(
        point >= 0x10000,
        F.array(0xD800 + F.floor((point - 0x10000) / 1024).cast("bigint"), 0xDC00 + (point - 0x10000) % 1024),
    ).otherwise(F.array(point))
    points = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))
    step = lambda h, unit: (h * 31 + unit) % F.lit(1 << 32)
    hashed = F.aggregate(F.flatten(F.transform(points, units)), F.lit(0).cast("bigint"), step)
    return F.when(hashed >= 1 << 31, hashed - (1 << 32)).otherwise(hashed)


def with_key_partition(messages: DataFrame, partitions: int) -> DataFrame:
    """Add ``partition``: the size of the key's text hash modulo ``partitions``.

    The lowest hash has no positive counterpart and counts as 0.
    """
    hashed = text_hash(F.col("key"))
    size = F.when(hashed == -(1 << 31), F.lit(0)).otherwise(F.abs(hashed))
    return messages.withColumn("partition", (size % partitions).cast("int"))


def with_numeric_partition(messages: DataFrame, partitions: int) -> DataFrame:
    """Add ``partition``: the number after the key's last dot modulo ``partitions``, else 0."""
    return messages.withColumn(
        "partition", numeric_suffix_partition(F.col("key"), partitions).cast("int")
    )


def placed(messages: DataFrame, partitions: int, order: tuple[str, ...] = ("key",)) -> DataFrame:
    """Messages with a ``partition`` column as one Spark partition per topic partition, in order.

    The number itself places a row, it is not hashed again: task i has the messages of partition i and
    no others, and empty partitions are empty tasks. A hot partition is one task, as it is one log;
    sorting spills. Each task of ``write_placed`` leaves the files of its partition.
    """
    return messages.repartitionById(partitions, F.col("partition").cast("int")).sortWithinPartitions(*order)


def write_placed(messages: DataFrame, path: str, partitions: int, order: tuple[str, ...] = ("key",)) -> None:
    """Files by topic partition, each in order; a file holds one partition."""
    placed(messages, partitions, ("partition", *order)).write.partitionBy("partition").parquet(path)
