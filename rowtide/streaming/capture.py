"""Live comparison of two feeds over a bounded capture time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_missing_changes(
    expected: DataFrame, found: DataFrame, time: str = "event_time", timesize: str = "5 minutes"
) -> DataFrame:
    """Change keys of the ``expected`` stream that ``found`` does not show within ``timesize``.

    Both streams carry ``change_key`` and an event time. A key is reported once the watermark
    has passed its capture time, which also bounds the state of both sides.
    """
    left = expected.select("change_key", F.col(time).alias("expected_at")).withWatermark(
        "expected_at", timesize
    )
    right = found.select(
        F.col("change_key").alias("found_key"), F.col(time).alias("found_at")
    ).withWatermark("found_at", timesize)
    near = F.expr(
        f"change_key = found_key and found_at >= expected_at - interval {timesize} "
        f"and found_at <= expected_at + interval {timesize}"
    )
    return (
        left.join(right, near, "leftOuter")
        .where(F.col("found_key").isNull())
        .select("change_key", "expected_at")
    )
