"""Probes over envelopes and records: table names, watched values, nulls, dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import map_dump
from rowtide.operators.records import expand_rows
from rowtide.operators.routing import dml_only

# Parts of column names the field probe looks for.
WATCHED_NAME = "product_id"
LISTED_NAMES = ("product_id", "created", "modified")


def tables_like(records: DataFrame, text: str) -> DataFrame:
    """Records whose table name contains the text."""
    return records.where(F.col("tab").contains(text))


def listed_columns(envelopes: DataFrame, names: Sequence[str] = LISTED_NAMES) -> DataFrame:
    """Cells of DML rows (before on DELETE, else after) whose name contains one of the texts.

    The filter runs inside the array, so cells of no interest are never exploded.
    """
    rows = expand_rows(dml_only(envelopes))
    image = F.when(F.col("event_type") == "DELETE", F.col("before")).otherwise(F.col("after"))

    def named(cell: Column) -> Column:
        hit = F.lit(False)
        for name in names:
            hit = hit | cell["name"].contains(name)
        return hit

    return rows.select(
        "src_partition",
        "src_offset",
        "row_no",
        F.col("header.schema_name").alias("db"),
        F.col("header.table_name").alias("tab"),
        F.explode_outer(F.filter(image, named)).alias("_cell"),
    ).where(F.col("_cell").isNotNull()).select(
        "src_partition",
        "src_offset",
        "row_no",
        "db",
        "tab",
        F.col("_cell.name").alias("name"),
        F.coalesce("_cell.value", F.lit("")).alias("value"),
    )


def watched_cells(
    envelopes: DataFrame, watch_list: DataFrame, name: str = WATCHED_NAME
) -> DataFrame:
    """Cells of DML rows whose name contains ``name`` and whose value is on the watch list."""
    return listed_columns(envelopes, [name]).join(
        watch_list.select("value").distinct(), "value", "left_semi"
    )


def watched_values(
    records: DataFrame, watch_list: DataFrame, name: str = WATCHED_NAME
) -> DataFrame:
    """Entries of the ``cur`` map whose name contains ``name`` and whose value is watched."""
    entries = F.filter(F.map_entries("cur"), lambda kv: kv["key"].contains(name))
    return (
        records.select(
            "src_partition", "src_offset", "row_no", "db", "tab", F.explode_outer(entries).alias("_kv")
        )
        .where(F.col("_kv").isNotNull())
        .select(
            "src_partition",
            "src_offset",
            "row_no",
            "db",
            "tab",
            F.col("_kv.key").alias("name"),
            F.col("_kv.value").alias("value"),
        )
        .join(watch_list.select("value").distinct(), "value", "left_semi")
    )


def image_cells(records: DataFrame, *keep: str) -> DataFrame:
    """The ``cur`` and ``src`` maps in long form: side, name, value."""
    cells = records.select(
        *keep, F.inline_outer(F.concat(_side_cells("cur"), _side_cells("src")))
    )
    return cells.where(F.col("side").isNotNull())


def _side_cells(side: str) -> Column:
    return F.transform(
        F.coalesce(F.map_entries(side), F.array()),
        lambda kv: F.struct(
            F.lit(side).alias("side"), kv["key"].alias("name"), kv["value"].alias("value")
        ),
    )


def null_audit(records: DataFrame) -> DataFrame:
    """Null and empty values by table, side and column."""
    return (
        image_cells(records, "db", "tab")
        .groupBy("db", "tab", "side", "name")
        .agg(
            F.count("*").alias("values"),
            F.count_if(F.col("value").isNull()).alias("null_values"),
            F.count_if(F.col("value") == "").alias("empty_values"),
        )
    )


def dump_maps(records: DataFrame) -> DataFrame:
    """The three maps of each record as text."""
    return records.select(
        "src_partition",
        "src_offset",
        "row_no",
        *[map_dump(F.col(side)).alias(side) for side in ("src", "cur", "cus")],
    )


def dump_records(records: DataFrame) -> DataFrame:
    """Decoded records as a listing: table, operation, ddl, custom and current map."""
    return records.select(
        "db",
        "tab",
        "opt",
        "ddl",
        map_dump(F.col("cus")).alias("cus"),
        map_dump(F.col("cur")).alias("cur"),
    )
