"""Options for Spark's Kafka source and sink.

The Kafka package is not part of Spark itself; the readers need it on the classpath. Everything
else works on the frames they return.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def starting_offsets(positions: DataFrame) -> str:
    """``startingOffsets`` for a topic: one entry per source partition.

    The rows are folded to one JSON text in Spark; it is as long as the topic has partitions.
    """
    per_topic = positions.groupBy("src_topic").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct(F.col("src_partition").cast("string"), "next_offset"))
            )
        ).alias("offsets")
    )
    document = per_topic.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("src_topic", "offsets")))).alias("d")
    )
    return document.first()["d"]


def source_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Options of the Kafka source; offsets out of range do not fail the query by default."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def explicit_offset(topic: str, partition: int, offset: int) -> str:
    """``startingOffsets`` for one partition from one offset."""
    return json.dumps({topic: {str(partition): offset}})


def read_topic(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Messages with their place in the source; decode them with ``sources.wire``."""
    reader = spark.readStream if streaming else spark.read
    if not streaming:
        options = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return (
        reader.format("kafka")
        .options(**options)
        .load()
        .select(
            F.col("topic").alias("src_topic"),
            F.col("partition").alias("src_partition"),
            F.col("offset").alias("src_offset"),
            "timestamp",
            "value",
        )
    )
