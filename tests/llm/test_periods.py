"""Periodic runs against brute force over all periods, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import periods
from rowtide.llm.queries import QUERIES, op12_periodic_runs
from tests.llm.test_operators import ODD, TABLES, docs_of, documents


def runs_of(w, shortest=24, power=3):
    """Every maximal stretch of every period; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(w) // power + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, power * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    """The row that the query has for a document."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = runs_of(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha(lines), sha(kept))


def test_query_matches_brute_force(spark):
    rows = [expected(r.doc_id, r.text) for r in documents(spark).where(F.length("text") < 12_000).collect()]
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, TABLES).collect()}
    assert [got[row[0]] for row in rows] == rows and sum(row[1] > 0 for row in rows) > 10


def text_of(rng):
    """A few letters as words: random, periodic, broken periods, powers of powers, Fibonacci."""
    kind = rng.randrange(6)
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(300))]
    if kind == 1:
        return ([rng.randrange(3) for _ in range(rng.randrange(1, 60))] * rng.randrange(1, 9))[: rng.randrange(1, 400)]
    if kind == 2:
        return ([0] * rng.randrange(1, 60) + [1]) * rng.randrange(1, 9) + [0] * rng.randrange(40)
    if kind == 3:
        parts = [[rng.randrange(2) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 20) for _ in range(rng.randrange(1, 6))]
        return sum(parts, []) * rng.randrange(1, 4)
    if kind == 4:
        return [rng.randrange(50) for _ in range(rng.randrange(300))]
    a, b = [0], [1]
    for _ in range(rng.randrange(12)):
        a, b = a + b, a
    return a[:500]


@pytest.mark.parametrize(("shortest", "power"), [(24, 3), (3, 3), (10, 3), (40, 4)])
def test_runs_match_brute_force(shortest, power):
    rng = random.Random(shortest)
    for _ in range(60):
        texts = [text_of(rng) for _ in range(rng.randrange(1, 4))]
        begins, ids = [], [-1]
        for text in texts:
            begins.append(len(ids))
            ids += [*text, -1]
        ids = np.array(ids, np.int32)
        seps = np.flatnonzero(ids < 0)
        ids[seps] = 1000 + np.arange(len(seps))
        got = periods.find_runs(ids, max(map(len, texts)), shortest, power)
        want = sorted((a + b, n, q) for b, text in zip(begins, texts, strict=True) for a, n, q in runs_of(text, shortest, power))
        assert sorted(zip(*(x.tolist() for x in got), strict=True)) == want


def test_wavelet_tree_counts_and_orders():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1000, 700)
    tree = periods.WaveletTree(values, 10)
    low = rng.integers(0, 700, 300)
    high = low + rng.integers(1, 60, 300).clip(max=700 - low)
    bound = rng.integers(0, 1000, 300)
    rank = rng.integers(0, high - low)
    parts = [np.sort(values[a:b]) for a, b in zip(low, high, strict=True)]
    assert tree.less(low, high, bound).tolist() == [int((p < x).sum()) for p, x in zip(parts, bound, strict=True)]
    assert tree.nth(low, high, rank).tolist() == [int(p[k]) for p, k in zip(parts, rank, strict=True)]


def test_collapsed_texts(spark):
    frame = docs_of(spark, "start " + "a b c " * 10 + "end", "x\ty\nz", None, "w " * 30)
    rows = {r.doc_id: r for r in periods.periodic_runs(frame).collect()}
    assert [r.collapsed for _, r in sorted(rows.items())] == ["start a b c end", "x y z", "", "w"]
    assert [tuple(x) for x in rows[0].runs] == [(1, 30, 3)] and rows[2].runs == [] and rows[2].n_words == 0


def test_odd_rows(spark):
    frame = docs_of(spark, *ODD, *ODD, ids=[7, 5, 6, None, 9, 9, 3, None, *range(100, 100 + len(ODD))])
    rows = op12_of(frame)
    want = sorted((expected(i, t) for i, t in zip([7, 5, 6, None, 9, 9, 3, None, *range(100, 100 + len(ODD))], [*ODD, *ODD], strict=True)), key=str)
    assert sorted(rows, key=str) == want
    assert periods.periodic_runs(frame.limit(0)).count() == 0


def op12_of(frame):
    spark = frame.sparkSession
    frame.createOrReplaceTempView("odd_rows")
    import rowtide.llm.queries as queries

    kept, queries.table = queries.table, lambda *_: spark.table("odd_rows")
    try:
        return [tuple(r) for r in op12_periodic_runs(spark, "").collect()]
    finally:
        queries.table = kept


def test_long_texts_take_time_in_proportion(spark):
    texts = ["same " * 200_000, ("a " * 400 + "b ") * 500, " ".join(f"w{i * i % 65_537}" for i in range(200_000))]
    rows = {r.doc_id: r for r in periods.periodic_runs(docs_of(spark, *texts)).collect()}
    assert [tuple(x) for x in rows[0].runs] == [(0, 200_000, 1)] and rows[0].collapsed == "same"
    assert (0, 200_500, 401) in [tuple(x) for x in rows[1].runs] and len(rows[1].runs) == 501
    assert [tuple(x) for x in rows[2].runs] == [(0, 200_000, 65_537)]
