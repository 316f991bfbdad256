"""Text helpers: comma lists, positions, map dumps and key suffixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of key parts, fields of the position text.
KEY_SEPARATOR = "\u0001"
POSITION_FIELDS = ("src_topic", "src_partition", "next_offset", "batch_id", "in_id", "mid")


def key_list(text: Column) -> Column:
    """Comma list of key columns: trailing empty parts vanish, spaces stay, null stays null."""
    return F.when(text.rlike("^,+$"), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(text, ",+$", ""), ",")
    )


def compact_list(text: Column) -> Column:
    """Comma list of sensitive columns: every empty part vanishes, null stays null."""
    return F.filter(F.split(text, ","), lambda part: part != "")


def db_table(schema: Column, table: Column) -> Column:
    return F.concat(schema, F.lit("."), table)


def position_text(*fields: Column) -> Column:
    """``topic:partition:offset:batchId:inId:uId``."""
    return F.concat_ws(":", *[field.cast("string") for field in fields])


def position_parts(text: Column) -> Column:
    """Parts of a position text; trailing empty parts do not count, as in the old readers."""
    return F.split(F.regexp_replace(text, ":+$", ""), ":")


def map_dump(entries: Column) -> Column:
    """``[k,v][k,v]`` in key order; a null value prints ``null``, a null map nothing."""
    pairs = F.array_sort(F.map_entries(entries))
    dumped = F.array_join(
        F.transform(
            pairs,
            lambda kv: F.concat(
                F.lit("["), kv["key"], F.lit(","), F.coalesce(kv["value"], F.lit("null")), F.lit("]")
            ),
        ),
        "",
    )
    return F.coalesce(dumped, F.lit(""))


def numeric_suffix_partition(key: Column, partitions: int) -> Column:
    """Number after the last dot modulo ``partitions``; no dot, or only a leading one, gives 0."""
    suffix = F.substring_index(key, ".", -1)
    has_dot = F.length(key) - F.length(suffix) > 1
    return F.when(has_dot, suffix.cast("int") % F.lit(partitions)).otherwise(F.lit(0))
