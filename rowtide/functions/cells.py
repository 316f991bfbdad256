"""Expressions over the cells (column values) of one changed row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions.text import KEY_SEPARATOR
from rowtide.schemas import CELLS, EVENT_TYPES, TEXT_LIST, TEXT_MAP


def no_cells() -> Column:
    return F.array().cast(CELLS)


def empty_map() -> Column:
    return F.create_map().cast(TEXT_MAP)


def null_map() -> Column:
    return F.lit(None).cast(TEXT_MAP)


def without(cells: Column, names: Column) -> Column:
    """Cells whose name is not listed; a null list removes nothing."""
    listed = F.coalesce(names, F.array().cast(TEXT_LIST))
    return F.filter(cells, lambda cell: ~F.array_contains(listed, cell["name"]))


def cell_value(cell: Column, null_mode: str = "keep") -> Column:
    """The cell's text; a NULL cell is null ('keep') or the empty text its message carries."""
    if null_mode == "keep":
        return F.when(F.coalesce(cell["is_null"], F.lit(False)), F.lit(None)).otherwise(
            F.coalesce(cell["value"], F.lit(""))
        )
    return F.coalesce(cell["value"], F.lit(""))


def cells_map(cells: Column, null_mode: str = "keep") -> Column:
    """Name-to-text map of the cells; of cells with the same name the last one counts."""
    return F.map_from_entries(
        F.transform(cells, lambda cell: F.struct(cell["name"], cell_value(cell, null_mode)))
    )


def key_cells(cells: Column, key_columns: Column) -> Column:
    """Cells named in the business key, in row order; a null key list matches none."""
    listed = F.coalesce(key_columns, F.array().cast(TEXT_LIST))
    return F.filter(cells, lambda cell: F.array_contains(listed, cell["name"]))


def joined_key(cells: Column) -> Column:
    """Texts of the given cells joined with U+0001; null when there is no cell at all."""
    return F.when(
        F.size(cells) > 0,
        F.array_join(
            F.transform(cells, lambda cell: F.coalesce(cell["value"], F.lit(""))), KEY_SEPARATOR
        ),
    )


def operation_label(event_type: Column) -> Column:
    """Known event types by name, others UNKNOWN; undecodable changes (null) read ``NULL``."""
    return F.when(event_type.isNull(), F.lit("NULL")).when(
        event_type.isin(*EVENT_TYPES), event_type
    ).otherwise(F.lit("UNKNOWN"))
