"""The stored-table form of the conversion: scan stored messages, convert, store entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.envelopes import envelope_records, readable
from rowtide.options import DEFAULT_WIDTHS
from rowtide.sinks.tables import stored_entries
from rowtide.sources.wire import encode_records


def converted_entries(
    envelopes: DataFrame, ts: Column, start: int = 0, widths: tuple[int, ...] = DEFAULT_WIDTHS
) -> DataFrame:
    """One encoded record per envelope at its running row key."""
    encoded = encode_records(envelope_records(envelopes, ts))
    return stored_entries(encoded, "value", start, widths)


def readable_entries(
    envelopes: DataFrame, now: Column, start: int = 0, widths: tuple[int, ...] = DEFAULT_WIDTHS
) -> DataFrame:
    """The older stored form: the readable text of each envelope at its running row key."""
    texts = readable(envelopes, now)
    return stored_entries(texts.withColumn("text", F.coalesce("text", F.lit(""))), "text", start, widths)
