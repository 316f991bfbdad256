"""Operators at envelope grain: conversion, last row per key, summaries, readable text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions import cells as C
from rowtide.operators.ordering import is_end
from rowtide.operators.records import current_cells, source_cells


def _is_ddl() -> Column:
    return F.coalesce(F.col("row_change.is_ddl"), F.lit(False))


def _event_type() -> Column:
    # A message without a row change reads as one with the default type.
    return F.coalesce("row_change.event_type", F.lit("UPDATE"))


def _rows() -> Column:
    return F.coalesce(F.size("row_change.row_datas"), F.lit(0))


def with_end_flag(envelopes: DataFrame) -> DataFrame:
    """Flag envelopes that end an output batch."""
    return envelopes.withColumn("is_end", is_end(F.col("entry_type"), F.col("row_change.is_ddl")))


def envelope_records(envelopes: DataFrame, ts: Column) -> DataFrame:
    """One record per envelope: the image of its last row counts, updates carry no maps.

    NULL cells become the empty text; the record id stays 0, the custom map null, and no key is
    made. Without rows both maps are null.
    """
    last = F.get("row_change.row_datas", _rows() - 1)
    staged = envelopes.withColumns(
        {
            "event_type": _event_type(),
            "before": F.coalesce(last["before"], C.no_cells()),
            "after": F.coalesce(last["after"], C.no_cells()),
        }
    )
    event_type = F.col("event_type")
    mapped = (_rows() > 0) & (event_type != "UPDATE")
    schema_name = F.coalesce("header.schema_name", F.lit(""))
    return staged.select(
        "src_topic",
        "src_partition",
        "src_offset",
        F.lit(0).cast("bigint").alias("mid"),
        schema_name.alias("db"),
        schema_name.alias("sch"),
        F.coalesce("header.table_name", F.lit("")).alias("tab"),
        C.operation_label(event_type).alias("opt"),
        ts.cast("bigint").alias("ts"),
        _ddl_text().alias("ddl"),
        F.lit("").alias("err"),
        *_mapped_images(mapped, event_type),
        C.null_map().alias("cus"),
    )


def last_row_per_key(routed: DataFrame, ts: Column, on_missing_key: str = "fail") -> DataFrame:
    """Last record per business key inside each envelope.

    Key columns count only where they belong to the primary key too; updates carry no maps, NULL
    cells become the empty text. The rows of one envelope are one array, so the last put wins
    inside the row, without a shuffle.
    """
    def keyed(row: Column, position: Column) -> Column:
        image = F.when(_event_type() == "DELETE", row["before"]).when(
            _event_type().isin("INSERT", "UPDATE"), row["after"]
        )
        key = C.joined_key(
            C.key_cells(F.filter(image, lambda cell: cell["is_key"]), F.col("key_columns"))
        )
        if on_missing_key == "fail":
            key = F.coalesce(key, F.raise_error(F.lit("no key column found")).cast("string"))
        return F.struct(key.alias("key"), F.struct(position.alias("row_no"), row.alias("row")))

    entries = F.filter(
        F.transform("row_change.row_datas", keyed), lambda entry: entry["key"].isNotNull()
    )
    kept = [c for c in routed.columns if c != "row_change"]
    rows = routed.select(
        *kept,
        _event_type().alias("event_type"),
        _ddl_text().alias("ddl"),
        F.explode(F.map_from_entries(entries)).alias("key", "_last"),
    ).withColumns(
        {
            "row_no": F.col("_last.row_no"),
            "before": F.coalesce("_last.row.before", C.no_cells()),
            "after": F.coalesce("_last.row.after", C.no_cells()),
        }
    )
    event_type = F.col("event_type")
    mapped = event_type != "UPDATE"
    first_mid = F.col("first_mid") if "first_mid" in routed.columns else F.lit(0)
    return rows.select(
        "src_partition",
        "src_offset",
        "topic",
        "key",
        "row_no",
        (first_mid + F.col("row_no")).cast("bigint").alias("mid"),
        F.col("header.schema_name").alias("db"),
        F.col("header.table_name").alias("tab"),
        C.operation_label(event_type).alias("opt"),
        ts.cast("bigint").alias("ts"),
        "ddl",
        *_mapped_images(mapped, event_type),
    )


def summarize(envelopes: DataFrame, row: str = "last", keep: Sequence[str] = ()) -> DataFrame:
    """Short description of each envelope: place in the log, table, first column of one row.

    ``keep`` names further columns to carry along, such as a flush number.
    """
    position = _rows() - 1 if row == "last" else F.lit(0)
    cell = F.get(F.get("row_change.row_datas", position)["after"], F.lit(0))
    info = F.concat(cell["name"], F.lit(" ## "), F.coalesce(cell["value"], F.lit("")))
    return envelopes.select(
        *keep,
        "src_partition",
        "src_offset",
        "entry_type",
        F.col("header.logfile_name").alias("logfile_name"),
        F.col("header.logfile_offset").alias("now_pos"),
        (F.col("header.logfile_offset") + F.col("header.event_length")).alias("next_pos"),
        F.col("header.schema_name").alias("schema_name"),
        F.col("header.table_name").alias("table_name"),
        F.coalesce(info, F.lit("null")).alias("column_info"),
        C.operation_label(_event_type()).alias("op"),
    )


def last_of(summaries: DataFrame, group: Sequence[str], order: str = "src_offset") -> DataFrame:
    """The last summary of each group (a flush, an output batch, a source partition)."""
    rest = [c for c in summaries.columns if c not in group]
    return (
        summaries.groupBy(*group)
        .agg(F.max_by(F.struct(*rest), order).alias("_last"))
        .select(*group, "_last.*")
    )


def readable(envelopes: DataFrame, now: Column) -> DataFrame:
    """Readable text of each envelope; heartbeats have none."""
    header = F.col("header")
    place = [
        F.lit('{"binlog name":'), header["logfile_name"],
        F.lit(',"log file offset":'), header["logfile_offset"].cast("string"),
    ]
    times = [
        F.lit(',"execute time":'), header["execute_time"].cast("string"),
        F.lit(',"delay time":'), (now - header["execute_time"]).cast("string"),
    ]
    begin = F.concat(
        *place, *times, F.lit(',"BEGIN ----> Thread id":'),
        F.coalesce(F.col("tx_begin.thread_id"), F.lit(0)).cast("string"),
    )
    end = F.concat(
        *place, *times, F.lit(',"END ----> Thread id":'),
        F.coalesce("tx_end.transaction_id", F.lit("")),
    )
    event_type = _event_type()
    rows = F.array_join(
        F.transform(
            F.coalesce("row_change.row_datas", F.array()),
            lambda row: F.when(event_type == "DELETE", _columns_text(row["before"]))
            .when(event_type == "INSERT", _columns_text(row["after"]))
            .otherwise(
                F.concat(
                    _columns_text(row["before"]),
                    _columns_text(row["after"]),
                    _changed_text(row["after"]),
                )
            ),
        ),
        "",
    )
    change = F.concat(
        *place,
        F.lit(',"schema name":'), header["schema_name"],
        F.lit(',"table name":'), header["table_name"],
        F.lit(',"event type":'), event_type,
        *times,
        F.when(_is_ddl(), F.concat(F.lit(',"SQL:"'), "row_change.sql")).otherwise(F.lit("")),
        rows,
    )
    text = (
        F.when(F.col("entry_type") == "TRANSACTIONBEGIN", begin)
        .when(F.col("entry_type") == "TRANSACTIONEND", end)
        .when(F.col("entry_type") == "ROWDATA", change)
    )
    return envelopes.select("src_topic", "src_partition", "src_offset", "entry_type", text.alias("text"))


def _columns_text(cells: Column) -> Column:
    texts = F.transform(
        cells,
        lambda cell: F.concat(
            F.lit('"'), cell["name"], F.lit('":'), F.coalesce(cell["value"], F.lit("")),
            F.lit(',"type=":'), F.coalesce(cell["mysql_type"], F.lit("")),
            F.when(cell["updated"], F.lit(',"update":true')).otherwise(F.lit("")),
        ),
    )
    return _bracketed(texts)


def _changed_text(cells: Column) -> Column:
    texts = F.transform(
        cells,
        lambda cell: F.when(
            cell["is_key"] | cell["updated"],
            F.concat(
                F.lit('"'), cell["name"], F.lit('":'), F.coalesce(cell["value"], F.lit("")),
                F.lit(',"type":'), F.coalesce(cell["mysql_type"], F.lit("")),
            ),
        ).otherwise(F.lit("")),
    )
    return _bracketed(texts)


def _bracketed(texts: Column) -> Column:
    joined = F.coalesce(F.array_join(texts, "|"), F.lit(""))
    return F.concat(F.lit("["), joined, F.lit("]"))


def _mapped_images(mapped: Column, event_type: Column) -> list[Column]:
    before, after = F.col("before"), F.col("after")
    return [
        F.when(mapped, C.cells_map(source_cells(event_type, before), "empty")).alias("src"),
        F.when(mapped, C.cells_map(current_cells(event_type, before, after), "empty")).alias("cur"),
    ]


def _ddl_text() -> Column:
    return F.when(_is_ddl(), F.coalesce("row_change.sql", F.lit(""))).otherwise(F.lit(""))
