"""Change messages in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.schemas import JSON_CHANGE


def decode_json_changes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode ``{"data": {schema, table, operation, fields}}``; ``data`` may be escaped text.

    ``get_json_object`` returns the same text for an object and for escaped text, so one parse
    serves both. Messages that do not parse have null columns.
    """
    text = F.col(value).cast("string")
    change = F.from_json(F.get_json_object(text, "$.data"), JSON_CHANGE)
    return messages.withColumn("_change", change).select(
        *messages.columns, *[F.col(f"_change.{name}").alias(name) for name in JSON_CHANGE.names]
    )
