"""Change topics and stored events kept as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.ordering import per_partition, running_before, source_of
from rowtide.options import DEFAULT_WIDTHS
from rowtide.schemas import ENVELOPE

#: Positions that become literals of a scan's condition at most.
LITERAL_POSITIONS = 256


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelope table in Parquet; the fixed schema spares the inference."""
    return spark.read.schema(ENVELOPE).parquet(path)


def stream_envelopes(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """The same table as a stream of new files."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def from_positions(envelopes: DataFrame, positions: DataFrame) -> DataFrame:
    """Envelopes at or after the position of their source partition.

    ``positions`` (the source, next_offset) has one row per source partition; partitions without
    one are read from the start. Up to ``LITERAL_POSITIONS`` of them become a condition of literals,
    which the Parquet scan uses to leave out what lies before; more are looked up in a map.
    """
    keys = source_of(positions)
    rows = positions.select(*keys, "next_offset").where("next_offset is not null").limit(LITERAL_POSITIONS + 1).collect()
    if len(rows) > LITERAL_POSITIONS:
        start = per_partition(positions, "next_offset")["next_offset"]
        return envelopes.where(F.col("src_offset") >= F.coalesce(start, F.lit(0)))
    of = lambda row: reduce(and_, (F.col(k).eqNullSafe(row[k]) for k in keys))
    after = (of(row) & (F.col("src_offset") >= row.next_offset) for row in rows)
    unknown = ~reduce(or_, (of(row) for row in rows), F.lit(False))
    # The lowest position is a bound for all only if it is told which partitions have none.
    return envelopes.where(reduce(or_, after, unknown))


def from_offset(envelopes: DataFrame, start: int | str = "earliest") -> DataFrame:
    """Envelopes from an offset, from the 'earliest' one, or after the 'latest' one (none yet)."""
    if start == "earliest":
        return envelopes
    if start == "latest":
        return envelopes.limit(0)
    return envelopes.where(F.col("src_offset") >= F.lit(int(start)))


def scan_stored(events: DataFrame, start: int, span: int = 10_000) -> DataFrame:
    """Scan ``[start, start + span)`` of the stored events up to the first empty value.

    Row range and columns reach the Parquet scan; the stop row is a scalar of the same range.
    """
    window = events.where(
        (F.col("event_row") >= start) & (F.col("event_row") < start + span)
    ).select("event_row", "event_bytes")
    stop = window.where(_is_empty()).agg(F.min("event_row").alias("stop")).scalar()
    return window.where(F.col("event_row") < F.coalesce(stop, F.lit(start + span)))


def successive_scans(
    events: DataFrame, span: int = 10_000, start: int = 0, widths: Sequence[int] = DEFAULT_WIDTHS
) -> DataFrame:
    """All scans of the table from ``start`` on, one after another: ``scan_no`` of every stored event.

    A scan ends after ``span`` rows or at an empty one, and the next starts behind it, so every
    event that is there belongs to one scan. Between two empty rows scans have fixed places; how
    many there were before comes from the empty rows alone. Both are running values over chunks.
    """
    row = F.col("event_row")
    rows = events.where(row >= start).select("event_row", "event_bytes")
    rows = running_before(rows, (), "event_row", maxes={"_empty": F.when(_is_empty(), row)}, widths=widths)
    rows = rows.withColumn("_from", F.coalesce(F.col("_empty") + 1, F.lit(start)))
    scans = F.when(_is_empty(), F.ceil((row - F.col("_from")) / F.lit(span)).cast("bigint"))
    rows = running_before(rows, (), "event_row", sums={"_scans": F.coalesce(scans, F.lit(0).cast("bigint"))}, widths=widths)
    scan_no = F.col("_scans") + F.floor((row - F.col("_from")) / F.lit(span)).cast("bigint")
    return rows.where(~_is_empty()).select(scan_no.alias("scan_no"), "event_row", "event_bytes")


def _is_empty():
    """Nothing is stored there; stored bytes of length 0 are an event like any other."""
    return F.col("event_bytes").isNull()
