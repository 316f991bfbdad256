"""Positions: where a job stands in its source, and how to start from there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import POSITION_FIELDS, position_parts, position_text

_TYPES = dict(
    src_topic="string", src_partition="int", next_offset="bigint",
    batch_id="bigint", in_id="bigint", mid="bigint",
)


def positions_as_text(positions: DataFrame) -> DataFrame:
    """Add ``position``, the six-field text of each position row."""
    return positions.withColumn("position", position_text(*[F.col(n) for n in POSITION_FIELDS]))


def parse_positions(texts: DataFrame, column: str = "position", form: str = "strict") -> DataFrame:
    """Parse six-field position texts.

    ``status`` is 'ok', 'latest' or 'error'. In the 'strict' form an empty text is an error like
    any other malformed one; in the 'lenient' form it means "start at the latest offset", with
    all counters 0. Fields of an error row are null; ``require_positions`` turns it into a failure.
    """
    text = F.col(column)
    empty = text.isNull() | (text == "")
    parts = position_parts(text)
    ok = ~empty & (F.size(parts) == 6)
    blank = F.lit("latest") if form == "lenient" else F.lit("error")
    status = F.when(ok, F.lit("ok")).when(empty, blank).otherwise(F.lit("error"))
    fields = [
        F.when(ok, F.get(parts, F.lit(i)).cast(_TYPES[name]))
        .when(
            (status == "latest") & F.lit(name in ("batch_id", "in_id", "mid")),
            F.lit(0).cast(_TYPES[name]),
        )
        .alias(name)
        for i, name in enumerate(POSITION_FIELDS)
    ]
    return texts.select(*texts.columns, status.alias("status"), *fields)


def require_positions(parsed: DataFrame, column: str = "position") -> DataFrame:
    """Fail the job on a position that could not be read."""
    message = F.concat(F.lit("bad position: "), F.coalesce(column, F.lit("")))
    return parsed.withColumn(
        "status", F.when(F.col("status") == "error", F.raise_error(message)).otherwise(F.col("status"))
    )


def start_mid(parsed: DataFrame, configured: int = 0) -> DataFrame:
    """The checkpoint's record id goes before the configured one."""
    return parsed.withColumn("mid", F.coalesce("mid", F.lit(configured).cast("bigint")))


def clamp_offset(
    requested: Column, earliest: Column, latest: Column, out_of_range: Column | bool = True
) -> Column:
    """Offset to go on from: above latest -> latest, below earliest -> earliest, else latest.

    Applies only where the broker reported the offset as out of range.
    """
    flagged = out_of_range if isinstance(out_of_range, Column) else F.lit(out_of_range)
    moved = F.when(requested > latest, latest).when(requested < earliest, earliest).otherwise(latest)
    return F.when(flagged, moved).otherwise(requested)


def to_latest_offset(requested: Column, latest: Column, out_of_range: Column) -> Column:
    """The older readers' way: an offset out of range always becomes the latest."""
    return F.when(out_of_range, latest).otherwise(requested)
