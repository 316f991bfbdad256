"""Chat formatting with collapse of cumulative snapshots (operator 2), in DataFrame functions only.

A log that stores a conversation after every turn holds each as a prefix of the next. Rolling
hashes of the turn prefixes find those: a conversation whose whole hash is a proper prefix hash of
another one is anti-joined away, of equal ones that with the smallest id stays, and the maximal
ones are rendered.

The hash of a prefix is the running sum of its turns' hashes, each taken of the turn and its place,
in two lanes of 60 bits from SHA-256. So a conversation is a window over its rows, linear in its
turns. Hashes and ids decide alone; the texts of the conversations that stay join them at the end.

Turns are ordered by turn number, role and text; null sorts first. Repeated rows are
repeated turns. A null role is written as an empty one, a null text as an empty one, but either is
another turn than the empty one. Rows without a conversation id are one conversation each: nothing
says that they belong together. Columns beyond the four are not read; an empty table gives no rows.
A conversation is rendered as one value, so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.shared import prepare, stage

#: Fixed values of the markup.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"

#: Hexadecimal digits of a lane of a turn's hash, and the lanes.
_DIGITS, _LANES = 15, ("_a", "_b")


def _sized(value: Column) -> Column:
    """The text behind its length, so that joined texts stay apart; a null is none of them."""
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _turns(turns: DataFrame) -> DataFrame:
    kinds = (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))
    return turns.select(*(F.col(name).cast(kind).alias(name) for name, kind in kinds))


def _hashed(place: Column) -> list[Column]:
    """The lanes of the hash of the turn at a place."""
    digest = F.sha2(F.concat(place.cast("string"), F.lit("|"), _sized(F.col("role")), F.lit("|"), _sized(F.col("text"))), 256)
    return [
        F.conv(F.substring(digest, 1 + i * _DIGITS, _DIGITS), 16, 10).cast("decimal(20, 0)").alias(lane)
        for i, lane in enumerate(_LANES)
    ]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, k, is_whole and the rolling hash of the first k turns, for every k of every conversation."""
    rows = _turns(turns)
    inside = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = rows.where("conv_id is not null").withColumn("k", F.row_number().over(inside))
    known = known.select("conv_id", "turn", "role", "text", "k", *_hashed(F.col("k")))
    known = known.select(
        "conv_id", "k", F.lead("k").over(inside).isNull().alias("is_whole"),
        *(F.pmod(F.sum(lane).over(before), F.lit(1 << 60)).cast("long").alias(lane) for lane in _LANES),
    )
    one = F.lit(1)
    lone = rows.where("conv_id is null").select("conv_id", one.alias("k"), F.lit(True).alias("is_whole"), *_hashed(one))
    return known.unionByName(lone.withColumns({lane: F.col(lane).cast("long") for lane in _LANES}))


def maximal_ids(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and hash of the conversations that no longer one begins with.

    The hashes are written to the shared folder, so the texts are hashed and ordered once.
    """
    prepare(turns.sparkSession)
    every = stage(prefix_hashes(turns))
    longer = every.where("not is_whole").select(*_LANES)
    wholes = every.where("is_whole").groupBy(*_LANES).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"), F.any_value("k").alias("n_turns")
    )
    return wholes.join(longer, list(_LANES), "left_anti")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns, n_copies of the conversations that no longer one begins with."""
    kept = stage(maximal_ids(turns))
    turn = F.struct("turn", "role", "text")
    rows = _turns(turns)
    known = rows.where("conv_id is not null").join(kept.where("conv_id is not null"), "conv_id")
    known = known.groupBy("conv_id").agg(
        F.any_value("n_turns").alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("turns"), F.any_value("n_copies").alias("n_copies")
    )
    # A lone row that is kept has no conversation with an id beside it: its copies are lone rows too.
    lone = rows.where("conv_id is null").select(turn.alias("one"), *(lane.cast("long") for lane in _hashed(F.lit(1))))
    lone = lone.groupBy(*_LANES).agg(F.any_value("one").alias("one"))
    lone = lone.join(kept.where("conv_id is null"), list(_LANES)).select("conv_id", "n_turns", F.array("one").alias("turns"), "n_copies")
    return known.unionByName(lone)


def render(turns: Column) -> Column:
    """The turns in order, each between its marks."""
    line = lambda t: F.concat(
        F.lit(TURN_START), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(TURN_END + "\n")
    )
    return F.array_join(F.transform(turns, line), "")


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of every maximal conversation."""
    return maximal_conversations(turns).select("conv_id", "n_turns", "n_copies", render(F.col("turns")).alias("rendered"))
