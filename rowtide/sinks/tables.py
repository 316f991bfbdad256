"""Table sinks: records by topic, stored entries, positions and their history, monitor rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import position_text
from rowtide.operators.ordering import SOURCE, running_row_key, source_of
from rowtide.options import DEFAULT_WIDTHS
from rowtide.schemas import POSITIONS
from rowtide.sinks.commits import read_committed


def write_by_topic(records: DataFrame, path: str, mode: str = "append") -> None:
    """Records to Parquet, one folder per topic.

    Tasks write their own rows, so a hot topic is as many files as it has tasks and needs no
    shuffle. Rows held back for want of a key go to ``status=quarantine``, the others to
    ``status=sent``.
    """
    status = F.when(F.col("key").isNull(), F.lit("quarantine")).otherwise(F.lit("sent"))
    records.withColumn("status", status).write.mode(mode).partitionBy("status", "topic").parquet(
        path
    )


def stored_entries(
    entries: DataFrame, value: str, start: int = 0, widths: tuple[int, ...] = DEFAULT_WIDTHS
) -> DataFrame:
    """Entries with their running row key: one row per envelope, in source order."""
    numbered = running_row_key(entries, "src_offset", start, widths=widths)
    return numbered.select(*source_of(numbered), "entry_row", F.col(value).alias("value"))


def read_positions_before(spark: SparkSession, out: str, run: str, epoch: int) -> DataFrame | None:
    """Position rows of the step before this epoch of this run; None where there is none.

    A run is the life of one checkpoint folder, and its epochs count from 0. Steps count on over
    the runs of a job. Normally the step before is the run's epoch before; only at the start of a
    run all positions are read for the newest step. Epochs that were never published do not count:
    what they wrote is written anew.
    """
    last = _parquet_if_there(spark, f"{out}/positions/run={run}/epoch={epoch - 1}")
    if last is not None and not last.isEmpty():
        return last
    table = read_committed(spark, out, "positions", POSITIONS)
    earlier = table.where(~((F.col("run") == run) & (F.col("epoch") >= epoch)))
    newest = earlier.agg(F.max("step")).first()[0]
    return None if newest is None else earlier.where(F.col("step") == newest)


def _parquet_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def published_positions(positions: DataFrame) -> DataFrame:
    """Six-field position texts of the steps that sent something."""
    return positions.where(F.col("sent") > 0).select(
        "job",
        "step",
        position_text(
            F.col("src_topic"), F.col("src_partition"), F.col("next_offset"),
            F.col("batch_id"), F.col("in_id"), F.col("mid"),
        ).alias("position"),
    )


def position_history(positions: DataFrame) -> DataFrame:
    """One five-field position per job, source partition and minute; the last step wins."""
    text = position_text(
        F.col("src_topic"), F.col("src_partition"), F.col("next_offset"),
        F.col("batch_id"), F.col("in_id"),
    )
    minute = F.floor(F.col("written_at") / F.lit(60_000)).cast("bigint")
    return (
        positions.groupBy("job", *SOURCE, minute.alias("minute_no"))
        .agg(F.max_by(text, "step").alias("position"))
        .select("job", *SOURCE, *minute_parts(F.col("minute_no")), "position")
    )


def minute_parts(minute_no: Column) -> list[Column]:
    """Date, hour and time of a minute since the epoch, in UTC and free of the session zone."""
    of_day = F.pmod(minute_no, F.lit(1440))
    hour = F.lpad(F.floor(of_day / 60).cast("string"), 2, "0")
    minute = F.lpad((of_day % 60).cast("string"), 2, "0")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(minute_no / 1440).cast("int"))
    return [
        day.cast("string").alias("date"),
        hour.alias("hour"),
        F.concat(hour, F.lit(":"), minute).alias("time"),
    ]
