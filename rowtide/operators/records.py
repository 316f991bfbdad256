"""From routed envelopes to records: row expansion, images, keys, projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions import cells as C
from rowtide.options import ConvertOptions
from rowtide.schemas import RECORD_FIELDS, TEXT_LIST

# Names in the custom map of a record.
CUSTOM_TIME = "dmlts"
CUSTOM_IP = "ip"


def expand_rows(envelopes: DataFrame) -> DataFrame:
    """One row per changed row, in order (``row_no`` from 0); envelopes without rows yield none.

    The outer form is used, here and in the other expansions, because Spark adds a filter on the
    array's size to the inner one and then computes the array twice.
    """
    kept = [c for c in envelopes.columns if c not in ("row_change", "tx_begin", "tx_end")]
    rows = envelopes.select(
        *kept,
        F.col("row_change.event_type").alias("event_type"),
        F.posexplode_outer("row_change.row_datas").alias("row_no", "_row"),
    )
    return rows.where(F.col("row_no").isNotNull()).select(
        *kept,
        "event_type",
        "row_no",
        F.coalesce("_row.before", C.no_cells()).alias("before"),
        F.coalesce("_row.after", C.no_cells()).alias("after"),
    )


def drop_sensitive(rows: DataFrame) -> DataFrame:
    """Remove the sensitive columns of the table from both images, hence from the key too."""
    return rows.withColumns(
        {side: C.without(F.col(side), F.col("sensitive")) for side in ("before", "after")}
    )


def source_cells(event_type: Column, before: Column) -> Column:
    """Cells of the ``src`` image: all before columns of UPDATE and DELETE."""
    return F.when(event_type.isin("UPDATE", "DELETE"), before).otherwise(C.no_cells())


def current_cells(
    event_type: Column,
    before: Column,
    after: Column,
    key_columns: Column | None = None,
    update_image: str = "changed",
) -> Column:
    """Cells of the ``cur`` image: after columns, or the primary key of a deleted row.

    With 'changed', an update shows only the columns that changed or belong to the primary or
    the business key.
    """
    changed = after
    if update_image == "changed":
        keys = F.array().cast(TEXT_LIST) if key_columns is None else key_columns
        keys = F.coalesce(keys, F.array().cast(TEXT_LIST))
        changed = F.filter(
            after,
            lambda cell: cell["updated"] | cell["is_key"] | F.array_contains(keys, cell["name"]),
        )
    return (
        F.when(event_type == "INSERT", after)
        .when(event_type == "DELETE", F.filter(before, lambda cell: cell["is_key"]))
        .when(event_type == "UPDATE", changed)
        .otherwise(C.no_cells())
    )


def business_key(
    event_type: Column, before: Column, after: Column, key_columns: Column
) -> Column:
    """Values of the key columns in row order, joined with U+0001; null when none is found."""
    image = (
        F.when(event_type == "DELETE", before)
        .when(event_type.isin("INSERT", "UPDATE"), after)
        .otherwise(C.no_cells())
    )
    return F.when(F.size(key_columns) > 0, C.joined_key(C.key_cells(image, key_columns)))


def _image_columns(
    event_type: Column, before: Column, after: Column, options: ConvertOptions
) -> dict[str, Column]:
    keys = F.col("key_columns")
    current = C.cells_map(
        current_cells(event_type, before, after, keys, options.update_image), options.null_mode
    )
    if options.update_image == "none":
        current = F.when(event_type == "UPDATE", C.null_map()).otherwise(current)
    return {
        "src": C.cells_map(source_cells(event_type, before), options.null_mode),
        "cur": current,
        "key": business_key(event_type, before, after, keys),
    }


def add_images(rows: DataFrame, options: ConvertOptions) -> DataFrame:
    """Add the ``src`` and ``cur`` maps and the business ``key`` to expanded rows."""
    images = _image_columns(F.col("event_type"), F.col("before"), F.col("after"), options)
    return rows.withColumns(images).drop("before", "after")


def fold_images(envelopes: DataFrame, options: ConvertOptions) -> DataFrame:
    """The images of all rows of an envelope as one array, in place of its row change.

    Done before the ordered steps, so that their shuffle moves the maps that are sent and not
    the full cells; envelopes without a topic, and DDL, keep no rows.
    """
    wanted = F.col("topic").isNotNull() & ~F.coalesce(F.col("row_change.is_ddl"), F.lit(False))

    def visible(cells: Column) -> Column:
        cells = F.coalesce(cells, C.no_cells())
        if not options.drop_sensitive:
            return cells
        hidden = F.col("sensitive")
        return F.when(F.size(hidden) > 0, C.without(cells, hidden)).otherwise(cells)

    rows = F.transform(
        "row_change.row_datas",
        lambda row: F.struct(
            visible(row["before"]).alias("before"), visible(row["after"]).alias("after")
        ),
    )
    staged = envelopes.withColumns(
        {
            "_rows": F.when(wanted, rows),
            "event_type": F.col("row_change.event_type"),
            "is_ddl": F.coalesce("row_change.is_ddl", F.lit(False)),
            "sql": F.when(F.col("row_change.is_ddl"), F.col("row_change.sql")),
        }
    )
    event_type = F.col("event_type")
    images = F.transform(
        "_rows",
        lambda row: F.struct(
            *[
                column.alias(name)
                for name, column in _image_columns(
                    event_type, row["before"], row["after"], options
                ).items()
            ]
        ),
    )
    return staged.withColumn("images", images).drop("_rows", "row_change", "tx_begin", "tx_end")


def unfold_images(envelopes: DataFrame) -> DataFrame:
    """One row per image of ``fold_images``, in order (``row_no`` from 0)."""
    kept = [c for c in envelopes.columns if c != "images"]
    rows = envelopes.select(*kept, F.posexplode_outer("images").alias("row_no", "_image"))
    return rows.where(F.col("row_no").isNotNull()).select(*kept, "row_no", "_image.*")


def resolve_missing_key(rows: DataFrame, mode: str, ts: Column) -> DataFrame:
    """Treat rows without a key: fail, take the batch time, or leave the key null ('quarantine')."""
    if mode == "fail":
        message = F.concat(
            F.lit("no key column found for "), "header.schema_name", F.lit("."), "header.table_name"
        )
        return rows.withColumn("key", F.coalesce("key", F.raise_error(message).cast("string")))
    if mode == "batch_time":
        return rows.withColumn("key", F.coalesce("key", ts.cast("string")))
    return rows


def custom_map(execute_time: Column, ip: Column) -> Column:
    return F.create_map(
        F.lit(CUSTOM_TIME),
        F.coalesce(execute_time, F.lit(0)).cast("string"),
        F.lit(CUSTOM_IP),
        F.coalesce(ip, F.lit("")),
    )


def to_records(rows: DataFrame, ts: Column) -> DataFrame:
    """Project rows with images to records, with topic, key and their place in the source."""
    schema_name = F.coalesce("header.schema_name", F.lit(""))
    fields = {
        "mid": F.col("first_mid") + F.col("row_no"),
        "db": schema_name,
        "sch": schema_name,
        "tab": F.coalesce("header.table_name", F.lit("")),
        "opt": C.operation_label(F.col("event_type")),
        "ts": ts.cast("bigint"),
        "ddl": F.lit(""),
        "err": F.lit(""),
        "src": F.col("src"),
        "cur": F.col("cur"),
        "cus": custom_map(F.col("header.execute_time"), F.col("ip")),
    }
    return rows.select(
        "topic",
        "key",
        *[fields[name].alias(name) for name in RECORD_FIELDS],
        "src_topic",
        "src_partition",
        "src_offset",
        "row_no",
    )


def with_key(records: DataFrame) -> DataFrame:
    """Records that can be sent."""
    return records.where(F.col("key").isNotNull())


def quarantined(records: DataFrame) -> DataFrame:
    """Records held back because no key column was found."""
    return records.where(F.col("key").isNull())
