"""Encoded bytes of a record as one expression: parts are written as hex digits and joined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions.avro_size import long_size

# Branch marks of a union whose second branch is null, and the end of a map's blocks.
_FIRST, _NULL, _END = "00", "02", "00"


#: Groups of 7 bits that a length or count can need.
_SHORT = 5


def long_hex(value: Column, most: int = 10) -> Column:
    """A zig-zag variable-length integer: groups of 7 bits, all but the last marked.

    Most lengths and counts are one group; they are told first, so that the groups are not tried one by one.
    """
    value = value.cast("bigint")
    folded = F.shiftleft(value, 1).bitwiseXOR(F.shiftright(value, 63))
    n = long_size(value)
    group = lambda i: F.shiftrightunsigned(folded, 7 * i).bitwiseAND(F.lit(0x7F))
    digits = lambda byte: F.lpad(F.hex(byte), 2, "0")
    groups = [
        F.when(n == i + 1, digits(group(i))).when(n > i + 1, digits(group(i).bitwiseOR(F.lit(0x80)))) for i in range(most)
    ]
    return F.when(value.between(0, 63), digits(F.shiftleft(value, 1))).otherwise(F.concat_ws("", *groups))


def text_hex(text: Column) -> Column:
    return F.concat(long_hex(F.octet_length(text), _SHORT), F.hex(text.cast("binary")))


def optional_text_hex(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(_NULL)).otherwise(F.concat(F.lit(_FIRST), text_hex(text)))


def map_hex(entries: Column) -> Column:
    """A map-or-null union with nullable texts, as one block."""
    cells = F.transform(F.map_entries(entries), lambda kv: F.concat(text_hex(kv["key"]), optional_text_hex(kv["value"])))
    block = F.when(F.size(entries) > 0, F.concat(long_hex(F.size(entries), _SHORT), F.array_join(cells, ""))).otherwise(F.lit(""))
    return F.when(entries.isNull(), F.lit(_NULL)).otherwise(F.concat(F.lit(_FIRST), block, F.lit(_END)))


def record_bytes() -> Column:
    """The record in the current row (columns as in ``schemas.RECORD_BODY``)."""
    parts = [long_hex(F.col("mid"))]
    parts += [text_hex(F.col(name)) for name in ("db", "sch", "tab", "opt")]
    parts.append(long_hex(F.col("ts")))
    parts += [optional_text_hex(F.col(name)) for name in ("ddl", "err")]
    parts += [map_hex(F.col(name)) for name in ("src", "cur", "cus")]
    return F.unhex(F.concat(*parts))
