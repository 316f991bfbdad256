"""Spelling variants against brute force over all deletions, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from rowtide.llm import spelling
from rowtide.llm.queries import QUERIES
from tests.llm.test_operators import ODD, TABLES, docs_of, documents

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def counted(rows, length=7, damaged=True):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if damaged and doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= length
    return {w: k for w, k in n.items() if k}


def one_apart(a, b):
    """One code point inserted, deleted or replaced, by comparing both ends."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def groups(n, times=2, ratio=10):
    """Rows per word; words are compared within those that share a half of their letters."""
    words = sorted(w for w, k in n.items() if k >= times)
    by = defaultdict(list)
    for w in words:
        for key in {("<", w[: k], len(w) - k) for k in (len(w) // 2, (len(w) - 1) // 2, (len(w) + 1) // 2)} | {
            (">", w[k:], k) for k in (len(w) // 2, (len(w) - 1) // 2, (len(w) + 1) // 2)
        }:
            by[key[:2]].append(w)
    near = defaultdict(set)
    for some in by.values():
        for i, a in enumerate(some):
            for b in some[:i]:
                if one_apart(a, b):
                    near[a].add(b)
                    near[b].add(a)
    forms = {}
    for w in words:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n[w], len(near[w]), n[forms[w]] if forms[w] else None)
    return out


def rows_of(frame):
    rows = frame.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_halves_find_all_near_words():
    """The brute force's own shortcut against plain pairs."""
    rng = random.Random(5)
    n = {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 10))): rng.randrange(1, 500) for _ in range(150)}
    plain = {w: sum(one_apart(w, v) for v in n if n[v] >= 2) for w in n if n[w] >= 2}
    assert {w: row[3] for w, row in groups(n).items()} == plain


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    want = groups(counted(rows))
    assert rows_of(QUERIES["op13_spelling_variants"](spark, TABLES)) == want
    assert sum(row[0] is not None for row in want.values()) > 5


@pytest.mark.parametrize("letters", ["ab", "abc", "aéÿ"])
def test_dense_vocabularies_match_brute_force(spark, letters):
    """Words of few letters have many near words, runs of one letter, and tries that span partitions."""
    rng = random.Random(len(letters))
    n = {}
    for _ in range(300):
        n["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))] = 10 ** rng.randrange(5) * rng.randrange(1, 4)
    counts = spark.createDataFrame(list(n.items()), "word string, n long")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert rows_of(spelling.variant_groups(counts)) == groups(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_chains_are_followed_to_the_last(spark):
    n = {"aaaaaaa" + "b" * k: 20**k for k in range(1, 9)}
    got = rows_of(spelling.variant_groups(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == groups(n) and got["aaaaaaabb"][1] == "aaaaaaabbbbbbbb"


def test_odd_rows(spark):
    ids = [7, 5, 6, None, 9, 9, 3, None, 1, 2]
    odd = [*ODD, "ÉCOLE×÷abc ecolEabcde 1abcdefg2 ABCDEFG", "abcdefgĀhijklmn " * 3 + "z" * 70_000 + " " + "z" * 70_000]
    frame = docs_of(spark, *odd, ids=ids)
    assert rows_of(spelling.spelling_variants(frame, damaged=True)) == groups(counted(list(zip(ids, odd, strict=True))))
    assert rows_of(spelling.spelling_variants(frame)) == groups(counted(list(zip(ids, odd, strict=True)), damaged=False))
    assert spelling.spelling_variants(frame.limit(0)).count() == 0
