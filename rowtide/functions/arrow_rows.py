"""Arrow columns to Python rows and back, leaf by leaf: nested rows are not converted one by one."""

from __future__ import annotations

from itertools import accumulate, chain

import pyarrow as pa


def to_rows(column: pa.Array) -> list:
    """What ``to_pylist`` gives: structs as dicts, lists as lists, maps as lists of pairs."""
    kind = column.type
    if pa.types.is_struct(kind):
        names = [field.name for field in kind]
        rows = [dict(zip(names, row)) for row in zip(*map(to_rows, column.flatten()))]
    elif pa.types.is_list(kind):
        flat, at, rows = to_rows(column.flatten()), 0, []
        for n in column.value_lengths().fill_null(0).to_pylist():
            rows.append(flat[at : at + n])
            at += n
    elif pa.types.is_string(kind) or not column.null_count and (pa.types.is_integer(kind) or pa.types.is_boolean(kind)):
        # The same values, without an Arrow scalar for each.
        return column.to_numpy(zero_copy_only=False).tolist()
    else:
        return column.to_pylist()
    if column.null_count:
        rows = [row if valid else None for row, valid in zip(rows, column.is_valid().to_pylist(), strict=True)]
    return rows


def to_column(rows: list, kind: pa.DataType) -> pa.Array:
    """The column of such rows; a field that a dict lacks is null, and a map may be a dict."""
    if pa.types.is_struct(kind):
        given = [{} if row is None else row for row in rows]
        fields = [to_column([row.get(field.name) for row in given], field.type) for field in kind]
        return pa.StructArray.from_arrays(fields, fields=list(kind), mask=pa.array([row is None for row in rows], pa.bool_()))
    if pa.types.is_map(kind):
        rows = [list(row.items()) if isinstance(row, dict) else row for row in rows]
        pairs = list(chain.from_iterable(row or () for row in rows))
        keys, items = pa.array([k for k, _ in pairs], kind.key_type), pa.array([v for _, v in pairs], kind.item_type)
        return pa.MapArray.from_arrays(_offsets(rows), keys, items, type=kind)
    if pa.types.is_list(kind):
        flat = list(chain.from_iterable(row or () for row in rows))
        return pa.ListArray.from_arrays(_offsets(rows), to_column(flat, kind.value_type), type=kind)
    return pa.array(rows, kind)


def _offsets(rows: list) -> pa.Array:
    """Where each row begins among the values; null for a row that is null."""
    begins = accumulate((len(row or ()) for row in rows), initial=0)
    return pa.array([None if row is None else at for row, at in zip([*rows, ()], begins, strict=True)], pa.int32())
