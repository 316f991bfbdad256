"""Encoded size of a record in bytes, as a closed expression: no encoding is needed to sum it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def long_size(value: Column) -> Column:
    """Bytes of a zig-zag variable-length integer: 7 bits each, at most 10 bytes."""
    value = value.cast("bigint")
    # The magnitude that the sign bit folds onto: v for v >= 0, -v-1 below.
    folded = F.when(value < 0, F.bitwise_not(value)).otherwise(value)
    size = F.lit(10)
    for n in range(9, 0, -1):
        size = F.when(folded < F.lit(1 << (7 * n - 1)), F.lit(n)).otherwise(size)
    return size.cast("bigint")


def text_size(text: Column) -> Column:
    length = F.octet_length(text)
    return long_size(length) + length


def optional_text_size(text: Column) -> Column:
    """A text-or-null union: one byte for the branch, then the text."""
    return F.lit(1) + F.coalesce(text_size(text), F.lit(0))


def map_size(entries: Column) -> Column:
    """A map-or-null union with nullable texts: branch, one block with its count, end mark."""
    cells = F.aggregate(
        F.map_entries(entries),
        F.lit(0).cast("bigint"),
        lambda total, kv: total + text_size(kv["key"]) + optional_text_size(kv["value"]),
    )
    block = F.when(F.size(entries) > 0, long_size(F.size(entries)) + cells).otherwise(F.lit(0))
    return F.lit(1) + F.when(entries.isNull(), F.lit(0)).otherwise(block + F.lit(1))


def record_size() -> Column:
    """Size of the record in the current row (columns as in ``schemas.RECORD_BODY``)."""
    size = long_size(F.col("mid")) + long_size(F.col("ts"))
    for name in ("db", "sch", "tab", "opt"):
        size = size + text_size(F.col(name))
    for name in ("ddl", "err"):
        size = size + optional_text_size(F.col(name))
    for name in ("src", "cur", "cus"):
        size = size + map_size(F.col(name))
    return size.cast("bigint")
