"""Operators that need source order: repeat filter and numbering.

A source partition may hold a third of the log or all of it, so a window over the partition
would put it in one task. Instead the offsets are cut into chunks of fixed width; each chunk is
folded to one small row, the small rows are folded again in the same way, and the running value
at the start of a chunk is joined back to it. Every window then sees at most ``widths`` rows,
and the log is shuffled once, on (partition, chunk), for all ordered steps together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.options import DEFAULT_WIDTHS

TOPIC = "src_topic"
PARTITION = "src_partition"
# Offsets are ordered within a partition of a topic; both name it.
SOURCE = (TOPIC, PARTITION)
OFFSET = "src_offset"
CHUNK = "src_chunk"
ROW_COUNT = "row_count"
ORDINAL = "ordinal"


def source_of(df: DataFrame) -> list[str]:
    """The columns that name a source partition; tables of one topic may leave the topic out."""
    return [name for name in SOURCE if name in df.columns]


def _named_topic(df: DataFrame) -> DataFrame:
    """An envelope without a topic name counts as one of the topic ''; a null would join nothing."""
    return df.withColumn(TOPIC, F.coalesce(TOPIC, F.lit(""))) if TOPIC in df.columns else df


def with_chunks(df: DataFrame, widths: Sequence[int] = DEFAULT_WIDTHS) -> DataFrame:
    """Add the chunk number that later ordered steps share, so that they share one shuffle.

    ``row_count``, the rows an envelope will emit, is taken before that shuffle as well: a job
    that only counts then never moves the row images.
    """
    if CHUNK not in df.columns and widths:
        df = _named_topic(df).withColumn(CHUNK, _chunk_of(OFFSET, widths[0]))
    if ROW_COUNT not in df.columns and "row_change" in df.columns:
        is_ddl = F.coalesce(F.col("row_change.is_ddl"), F.lit(False))
        # One side of the rows is enough to count them, so the scan skips the other.
        rows = F.greatest(F.size("row_change.row_datas.before"), F.lit(0))
        df = df.withColumn(
            ROW_COUNT, F.when(is_ddl, F.lit(0)).otherwise(F.coalesce(rows, F.lit(0)))
        )
    return df


def per_partition(rows: DataFrame, *columns: str) -> Column:
    """The given columns of the row for the current source partition, as a struct; else null.

    The rows, one per source partition, become one map that is handed to every task. So the log
    is not joined, which would hash it on so few keys; the map is as long as the topic has
    partitions.
    """
    keys = source_of(rows)
    entries = F.map_from_entries(F.collect_list(F.struct(F.struct(*keys), F.struct(*columns))))
    return F.try_element_at(rows.agg(entries.alias("m")).scalar(), F.struct(*keys))


def running_before(
    items: DataFrame,
    part: Sequence[str],
    order: str,
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    mark: tuple[str, Column] | None = None,
    widths: Sequence[int] = DEFAULT_WIDTHS,
    chunk: str | None = None,
) -> DataFrame:
    """Add, per row, running values over all earlier rows of its part, itself excluded.

    ``sums``   name -> expression; 0 where nothing is earlier.
    ``maxes``  name -> expression; null where nothing is earlier.
    ``mark``   (name, flag): how many rows came up to and with the last flagged one; null before
               the first. Needs ``ordinal`` among the sums, counting one per row.
    ``order``  is unique within a part. ``chunk`` names an existing chunk column for widths[0].
    """
    fold = _Fold(tuple(part), dict(sums or {}), dict(maxes or {}), mark)
    # Expressions become columns first: each is computed once and folded under its own name.
    staged = items.select("*", *[c.alias(f"_i_{n}") for n, c in fold.item_columns().items()])
    done = fold.run(staged, order, tuple(widths), chunk)
    return done.drop(*[f"_i_{name}" for name in fold.item_columns()])


class _Fold:
    """The fold of ``running_before``: item columns ``_i_*`` in, running columns out."""

    def __init__(self, part, sums, maxes, mark):
        self.part, self.sums, self.maxes, self.mark = part, sums, maxes, mark

    def item_columns(self) -> dict[str, Column]:
        columns = {**self.sums, **self.maxes}
        if self.mark:
            name, flag = self.mark
            columns[name] = F.when(flag, F.lit(1).cast("bigint"))
        return columns

    def run(self, items: DataFrame, order: str, widths: tuple, chunk: str | None) -> DataFrame:
        if not widths:
            return self._windows(items, self.part, order, "")
        given = chunk is not None
        chunk = chunk or f"_chunk_{len(widths)}"
        if not given:
            items = items.withColumn(chunk, _chunk_of(order, widths[0]))
        keys = [*self.part, chunk]
        local = self._windows(items, keys, order, "_l_")
        # Plain sums and maxima fold straight from the items, with map-side combine. The mark
        # counts rows inside the chunk, so it folds from the windowed rows, already in place.
        source = local if self.mark else items
        summary = source.groupBy(*keys).agg(*self._chunk_totals())
        base = self.run(summary, chunk, widths[1:], None).select(
            *keys, *[F.col(name).alias(f"_b_{name}") for name in self.item_columns()]
        )
        joined = local.join(base, keys)
        done = joined.select(*[F.col(c) for c in items.columns], *self._combined())
        return done if given else done.drop(chunk)

    def _windows(self, items: DataFrame, keys: Sequence[str], order: str, prefix: str) -> DataFrame:
        before = (
            Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        )
        zero = F.lit(0).cast("bigint")
        running = {
            prefix + name: F.coalesce(F.sum(f"_i_{name}").over(before), zero) for name in self.sums
        }
        running |= {prefix + name: F.max(f"_i_{name}").over(before) for name in self.maxes}
        out = items.withColumns(running)
        if self.mark:
            name = self.mark[0]
            reached = F.col(prefix + ORDINAL) + F.col(f"_i_{name}")
            out = out.withColumn(f"_r_{name}", reached)
            out = out.withColumn(prefix + name, F.max(f"_r_{name}").over(before))
            if not prefix:
                out = out.drop(f"_r_{name}")
        return out

    def _chunk_totals(self) -> list[Column]:
        totals = [F.sum(f"_i_{name}").alias(f"_i_{name}") for name in self.sums]
        totals += [F.max(f"_i_{name}").alias(f"_i_{name}") for name in self.maxes]
        if self.mark:
            totals.append(F.max(f"_r_{self.mark[0]}").alias(f"_i_{self.mark[0]}"))
        return totals

    def _combined(self) -> list[Column]:
        out = [(F.col(f"_b_{n}") + F.col(f"_l_{n}")).alias(n) for n in self.sums]
        out += [F.greatest(f"_b_{n}", f"_l_{n}").alias(n) for n in self.maxes]
        if self.mark:
            name = self.mark[0]
            inside = F.col(f"_b_{ORDINAL}") + F.col(f"_l_{name}")
            out.append(F.coalesce(inside, F.col(f"_b_{name}")).alias(name))
        return out


def drop_repeats(
    envelopes: DataFrame,
    last_kept: DataFrame | None = None,
    widths: Sequence[int] = DEFAULT_WIDTHS,
) -> DataFrame:
    """Keep an envelope only if (batch_id, in_id) is above that of every earlier one.

    The kept sequence only grows, so the last kept value is the running maximum of all earlier
    rows of the source partition. ``last_kept`` (the source, last_batch_id, last_in_id)
    carries the value over a restart; without it the first envelope always passes.
    """
    return mark_repeats(envelopes, last_kept, widths).where(~F.col("is_repeat")).drop("is_repeat")


def mark_repeats(
    envelopes: DataFrame,
    last_kept: DataFrame | None = None,
    widths: Sequence[int] = DEFAULT_WIDTHS,
) -> DataFrame:
    """Flag the envelopes that ``drop_repeats`` removes, to count or inspect them."""
    sequence = F.struct(_zero_if_unset("batch_id"), _zero_if_unset("in_id"))
    df = running_before(
        with_chunks(envelopes, widths),
        source_of(envelopes),
        OFFSET,
        maxes={"_seen": sequence},
        widths=widths,
        chunk=CHUNK if widths else None,
    )
    seen = F.col("_seen")
    if last_kept is not None:
        start = per_partition(last_kept, "last_batch_id", "last_in_id")
        start = F.struct(
            start["last_batch_id"].alias("batch_id"), start["last_in_id"].alias("in_id")
        )
        seen = F.greatest(seen, F.when(start["batch_id"].isNotNull(), start))
    passed = seen.isNull() | (sequence > seen)
    return df.withColumn("is_repeat", ~passed).drop("_seen")


def is_end(entry_type: Column, is_ddl: Column) -> Column:
    """An output batch ends with a transaction end or with a DDL change."""
    return (entry_type == "TRANSACTIONEND") | (
        (entry_type == "ROWDATA") & F.coalesce(is_ddl, F.lit(False))
    )


def number_envelopes(
    routed: DataFrame,
    starts: DataFrame | None = None,
    widths: Sequence[int] = DEFAULT_WIDTHS,
) -> DataFrame:
    """Number kept and routed envelopes: ``out_batch_id``, ``out_in_id`` and ``first_mid``.

    ``starts`` (the source, batch_id, in_id, mid) are the values at the checkpoint, 0 without.
    An envelope takes the current pair; after an ending one the batch steps on and the position
    in it returns to 0. ``first_mid`` is the record id of the envelope's first row.
    """
    is_ddl = F.col("is_ddl" if "is_ddl" in routed.columns else "row_change.is_ddl")
    ends = is_end(F.col("entry_type"), is_ddl)
    df = running_before(
        with_chunks(routed, widths),
        source_of(routed),
        OFFSET,
        sums={
            ORDINAL: F.lit(1).cast("bigint"),
            "_ends": ends.cast("bigint"),
            "_rows": F.col(ROW_COUNT).cast("bigint"),
        },
        mark=("_since", ends),
        widths=widths,
        chunk=CHUNK if widths else None,
    )
    zero = F.lit(0).cast("bigint")
    b0 = i0 = u0 = zero
    if starts is not None:
        start = per_partition(starts, "batch_id", "in_id", "mid")
        b0, i0, u0 = (F.coalesce(start[name], zero) for name in ("batch_id", "in_id", "mid"))
    place = F.coalesce(F.col(ORDINAL) - F.col("_since"), F.col(ORDINAL) + i0)
    return df.withColumns(
        {
            "out_batch_id": b0 + F.col("_ends"),
            "out_in_id": place,
            "first_mid": u0 + F.col("_rows"),
        }
    ).drop(ORDINAL, "_ends", "_rows", "_since")


def running_row_key(
    entries: DataFrame,
    order: str,
    start: int = 0,
    part: Sequence[str] | None = None,
    name: str = "entry_row",
    widths: Sequence[int] = DEFAULT_WIDTHS,
) -> DataFrame:
    """Running key of a stored entry table: ``start`` plus the number of earlier envelopes."""
    counted = running_before(
        _named_topic(entries), source_of(entries) if part is None else part, order, sums={name: F.lit(1).cast("bigint")}, widths=widths
    )
    return counted.withColumn(name, F.col(name) + F.lit(start))


def _zero_if_unset(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def _chunk_of(order: str, width: int) -> Column:
    return F.expr(f"cast(`{order}` as bigint) div {width}")
