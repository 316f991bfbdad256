"""The table of stored entries as sorted files with a zone map, and scans that open only what they need.

An append writes its entries by range of the row key, each file sorted, and then a zone file with every
file's first and last key, its rows and its entries without bytes. The append is there once its zone
file is, and files are never written again. A scan picks files by the zones alone.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.files import names_in, read_text, write_text

ENTRIES = "event_row bigint, event_bytes binary"
#: Rows of a file; a larger append makes more files.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class Zone:
    path: str
    first: int
    last: int
    rows: int
    empty: int


def append_entries(entries: DataFrame, store: str, file_rows: int = FILE_ROWS) -> list[Zone]:
    """Append rows (event_row, event_bytes); their keys may lie anywhere.

    The zones come from the files' own statistics of the key: a pass over that column alone.
    """
    spark = entries.sparkSession
    name = uuid.uuid4().hex
    rows = entries.select(F.col("event_row").cast("bigint"), F.col("event_bytes").cast("binary"))
    placed = rows.repartitionByRange("event_row").sortWithinPartitions("event_row")
    placed.write.option("maxRecordsPerFile", file_rows).option("compression", "zstd").parquet(f"{store}/append-{name}")
    written = spark.read.schema(ENTRIES).parquet(f"{store}/append-{name}")
    found = written.groupBy(F.input_file_name().alias("path")).agg(
        F.min("event_row").alias("first"), F.max("event_row").alias("last"), F.count("*").alias("rows"),
        F.count_if(F.col("event_bytes").isNull()).alias("empty"),
    )
    zones = sorted((Zone(**row.asDict()) for row in found.toLocalIterator()), key=lambda z: z.first)
    write_text(f"{store}/_zones/{name}.json", json.dumps([asdict(z) for z in zones]))
    return zones


def zones(store: str) -> list[Zone]:
    """The zone map: one entry per file of every finished append."""
    found = [Zone(**z) for name in names_in(f"{store}/_zones") for z in json.loads(read_text(f"{store}/_zones/{name}"))]
    return sorted(found, key=lambda z: (z.first, z.last, z.path))


def scan_store(spark: SparkSession, store: str, start: int, span: int = 10_000) -> DataFrame:
    """The entries of ``[start, start + span)`` up to the first without bytes, from the files that can hold them.

    Files behind the last one that can hold the stop are left out as well: the stop is looked up first
    in those that have empty entries.
    """
    low, high = start, start + span
    met = [z for z in zones(store) if z.first < high and z.last >= low]
    for zone in sorted((z for z in met if z.empty), key=lambda z: z.first):
        if zone.first >= high:
            break
        inside = _rows(spark, [zone]).where((F.col("event_row") >= low) & (F.col("event_row") < high))
        stop = inside.where("event_bytes is null").agg(F.min("event_row")).first()[0]
        high = high if stop is None else min(high, stop)
    met = [z for z in met if z.first < high]
    return _rows(spark, met).where((F.col("event_row") >= low) & (F.col("event_row") < high))


def _rows(spark: SparkSession, met: list[Zone]) -> DataFrame:
    if not met:
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(*(z.path for z in met))
