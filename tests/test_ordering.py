"""Ordered operators against the plain loop, over chunk widths, partitions and restarts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowtide import ConvertOptions, convert
from rowtide.operators.ordering import (
    drop_repeats,
    mark_repeats,
    number_envelopes,
    running_before,
    running_row_key,
)
from rowtide.operators.routing import route
from tests.builders import cell, envelope, envelopes, routes, row
from tests.sequential import run

ROUTES = {"s.a": ("ta", ["id"], None), "s.b": ("tb", ["id"], ["v"]), "s.": ("tx", None, None)}
WIDTHS = [(), (1,), (7,), (5, 2), (3, 2, 2), (65_536,)]


def spark_routes(spark):
    return routes(spark, ("a", "ta", "id", None), ("b", "tb", "id", "v"), ("", "tx", None, None))


def random_log(seed, partitions=2, size=150):
    rng = random.Random(seed)
    log = []
    for partition in range(partitions):
        offset, top = rng.randint(0, 50), 0
        for _ in range(size):
            offset += rng.choice((1, 1, 1, 2, 9))
            top += rng.choice((0, 1, 1, 2))
            back = rng.choice((0, 0, 0, 3))
            seq = (max(top - back, 0) // 5, max(top - back, 0) % 5)
            kind = rng.choice(("ROWDATA",) * 8 + ("TRANSACTIONEND", "HEARTBEAT"))
            table = rng.choice("abc") if kind == "ROWDATA" else ""
            rows = [
                row([cell("id", str(offset), True), cell("v", "x")],
                    [cell("id", str(offset), True), cell("v", "y", updated=True)])
                for _ in range(rng.randint(0, 3))
            ]
            log.append(
                envelope(offset, seq, rng.choice(("INSERT", "UPDATE", "DELETE")), rows, table,
                         partition=partition, kind=kind, ddl=kind == "ROWDATA" and rng.random() < 0.1,
                         unset=rng.random() < 0.03)
            )
    return log


def model(log, **options):
    numbered, records = [], []
    for partition in sorted({e["src_partition"] for e in log}):
        part = sorted(
            (e for e in log if e["src_partition"] == partition), key=lambda e: e["src_offset"]
        )
        one = run(part, ROUTES, **options)
        numbered += [(partition, *n) for n in one[0]]
        records += [(partition, *r) for r in one[1]]
    return sorted(numbered), sorted(records, key=lambda r: r[:3])


@pytest.mark.parametrize("widths", WIDTHS)
@pytest.mark.parametrize("seed", [1, 2])
def test_numbering_matches_the_loop(spark, seed, widths):
    log = random_log(seed)
    random.Random(0).shuffle(log)
    kept = drop_repeats(envelopes(spark, *log), widths=widths)
    numbered = number_envelopes(route(kept, spark_routes(spark)), widths=widths)
    got = sorted(
        tuple(r)
        for r in numbered.select(
            "src_partition", "src_offset", "out_batch_id", "out_in_id", "first_mid"
        ).collect()
    )
    assert got == model(log)[0]


@pytest.mark.parametrize("widths", [(), (7,), (5, 2)])
def test_conversion_matches_the_loop(spark, widths):
    log = random_log(3)
    options = ConvertOptions(on_missing_key="quarantine", widths=widths)
    got = convert(envelopes(spark, *log), spark_routes(spark), 1, options).select(
        "src_partition", "src_offset", "row_no", "topic", "key", "mid", "opt", "src", "cur"
    )
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:3]) == model(log)[1]


@pytest.mark.parametrize("widths", [(), (4,), (3, 2)])
def test_start_values_carry_over(spark, widths):
    log = [e for e in random_log(4, partitions=1)]
    starts = spark.createDataFrame(
        [(0, 3, 1, 40, 7, 500)],
        "src_partition int, last_batch_id long, last_in_id long, batch_id long, in_id long, mid long",
    )
    kept = drop_repeats(envelopes(spark, *log), starts, widths)
    numbered = number_envelopes(route(kept, spark_routes(spark)), starts, widths)
    got = sorted(
        tuple(r)
        for r in numbered.select(
            "src_partition", "src_offset", "out_batch_id", "out_in_id", "first_mid"
        ).collect()
    )
    assert got == model(log, start=(40, 7, 500), last=(3, 1))[0]


def test_a_repeat_is_not_a_duplicate(spark):
    """A late higher number is kept, a later lower one is not, equal ones are repeats."""
    log = [envelope(i, seq) for i, seq in enumerate([(1, 5), (1, 5), (2, 0), (1, 9), (2, 1), (0, 99)])]
    flags = mark_repeats(envelopes(spark, *log), widths=(2,)).orderBy("src_offset")
    assert [r.is_repeat for r in flags.collect()] == [False, True, False, True, False, True]


def test_unset_numbers_keep_only_the_first(spark):
    log = [envelope(i, unset=True) for i in range(4)]
    kept = drop_repeats(envelopes(spark, *log), widths=(2,))
    assert [r.src_offset for r in kept.collect()] == [0]


def test_first_envelope_passes_without_a_start(spark):
    starts = spark.createDataFrame(
        [(1, 9, 9)], "src_partition int, last_batch_id long, last_in_id long"
    )
    log = [envelope(0, (0, 0), partition=0), envelope(0, (0, 0), partition=1)]
    kept = drop_repeats(envelopes(spark, *log), starts, (4,))
    assert [(r.src_partition) for r in kept.collect()] == [0]


def test_unrouted_envelopes_move_the_sequence(spark):
    log = [envelope(0, (5, 0), table="nowhere"), envelope(1, (4, 0), table="a", rows=[])]
    options = ConvertOptions(on_missing_key="quarantine")
    from rowtide.plans.convert import routed_envelopes

    assert routed_envelopes(envelopes(spark, *log), spark_routes(spark), options).count() == 0


def test_running_row_key(spark):
    log = [envelope(o) for o in (5, 1, 9)]
    rows = running_row_key(envelopes(spark, *log), "src_offset", 10, widths=(4,)).collect()
    assert sorted((r.src_offset, r.entry_row) for r in rows) == [(1, 10), (5, 11), (9, 12)]


def test_running_values_over_whole_parts(spark):
    items = spark.range(1000).select(F.lit(0).alias("p"), F.col("id"))
    done = running_before(
        items, ["p"], "id", sums={"n": F.lit(1)}, maxes={"m": F.col("id")}, widths=(10, 3)
    )
    assert done.where("n != id or m != id - 1").count() == 0
    assert done.where("m is null").count() == 1
