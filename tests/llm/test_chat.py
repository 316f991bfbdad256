"""Conversation snapshots against a plain loop over all prefixes, and long conversations."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from rowtide.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def maximal(rows):
    """(conv_id, turns, copies) by comparing every conversation with every other."""
    known, convs = {}, []
    for conv_id, *turn in rows:
        if conv_id is None:
            convs.append((None, [turn]))
        else:
            known.setdefault(conv_id, []).append(turn)
    convs += known.items()
    first = lambda turn: [(v is not None, v) for v in turn]
    plain = [(i, tuple((role, text) for _, role, text in sorted(turns, key=first))) for i, turns in convs]
    prefixes = {turns[:k] for _, turns in plain for k in range(1, len(turns))}
    found = Counter()
    for turns in {t for _, t in plain} - prefixes:
        ids = [i for i, t in plain if t == turns]
        found[min((i for i in ids if i is not None), default=None), turns, len(ids)] += 1
    return found


def test_snapshots_match_brute_force(spark):
    rng = random.Random(3)
    pick = lambda: (rng.choice(["u", "b", None]), rng.choice(["", "a", "b", "1:a", None]))
    rows = []
    for conv_id in range(60):
        turns = [(k, *pick()) for k in range(rng.randrange(1, 4))]
        # repeated turns, turns of one number, and turns without one
        turns += [rng.choice(turns)] * rng.randrange(2) + [(None, *pick())] * rng.randrange(2)
        rows += [(conv_id, *t) for t in turns]
    rows += [(None, rng.randrange(3), *pick()) for _ in range(12)]
    frame = spark.createDataFrame(rows, TURNS).withColumn("n_turns", F.lit("mine")).withColumn("_a", F.lit(1)).withColumn("k", F.lit(1))
    got = Counter(
        (r.conv_id, tuple((t.role, t.text) for t in r.turns), r.n_copies) for r in chat.maximal_conversations(frame).collect()
    )
    assert got == maximal(rows)


def test_long_conversations_take_linear_work(spark):
    n = 100_000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    turns = turns.unionByName(turns.where("turn < 60000").withColumn("conv_id", F.lit(2)))
    (row,) = chat.maximal_conversations(turns).select("conv_id", "n_turns", "n_copies", F.size("turns").alias("size")).collect()
    assert (row.conv_id, row.n_turns, row.n_copies, row.size) == (1, n, 1, n)
