"""Periodic runs of words in every text, by internal pattern matching of dyadic blocks (operator 12).

A run of smallest period p and at least 3 p words holds a block of m words at a multiple of m, where m
is the power of two with m <= p < 2 m, together with the block's copy p words on. So every such block
asks where it occurs in the window of m starts that begins m words behind it:

* suffixes are sorted by prefix doubling, which on the way gives every block's interval of the suffix
  array; blocks that occur once ask nothing;
* a wavelet tree over the suffix array answers range successor queries: the first, second and last
  occurrence in the window. Occurrences so near to each other are an arithmetic progression.
* One or two occurrences are candidate periods as they are. Three or more have the block's own period
  r as their difference; the run then moves the end, or the start, of the stretch of period r around
  the block onto that around its copies, which leaves two candidates.
* Blocks of the least size also stand for the periods below it.

Candidates of one period are joined where they meet and extended word by word to maximal runs, each
stretch once. The same stretch under several periods has the smallest of them.

Texts are handled many at a time, a long one alone with up to 200 bytes a word in arrays. Nothing is
cut, as a run may be as long as its text.

Nulls and ties: a null text has no words. Rows that repeat a document are documents of their own.
Rows without a doc_id are kept. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.passages import pieces
from rowtide.llm.shared import prepare

SHORTEST = 24
POWER = 3
RUN = "struct<start: long, length: long, period: long>"
#: Words after which the texts so far are searched.
TOGETHER = 150_000
#: Comparisons that are made at once.
_AT_ONCE = 1 << 21


class WaveletTree:
    """Counts and order statistics of the values of any range of an array, as a matrix of bits per level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for bit in reversed(range(bits)):
            one = (values >> bit & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)))
            self.levels.append((bit, words, before, len(values) - int(one.sum())))
            values = np.concatenate((values[~one], values[one]))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        word = at >> 6
        return before[word] + np.bitwise_count(words[word] & mask)

    def less(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are below the given ones."""
        n = np.zeros(len(low), np.int64)
        for bit, words, before, zeros in self.levels:
            low1, high1 = self._ones(words, before, low), self._ones(words, before, high)
            one = (value >> bit & 1).astype(bool)
            n += np.where(one, (high - high1) - (low - low1), 0)
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return n

    def nth(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of this rank (from 0) among those of [low, high); it must exist."""
        value = np.zeros(len(low), np.int64)
        for bit, words, before, zeros in self.levels:
            low1, high1 = self._ones(words, before, low), self._ones(words, before, high)
            n = (high - high1) - (low - low1)
            one = rank >= n
            rank = np.where(one, rank - n, rank)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return value


def _agreeing(ids: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray, sign: int = 1) -> np.ndarray:
    """How many words from a and from b on (or backwards) agree, up to the limit."""
    out = np.zeros(len(a), np.int64)
    todo = np.flatnonzero(limit > 0)
    step, last = 8, len(ids) - 1
    while len(todo):
        further = []
        size = max(1, _AT_ONCE // step)
        for at in range(0, len(todo), size):
            rows = todo[at : at + size]
            off = out[rows, None] + np.arange(step)
            equal = ids[np.clip(a[rows, None] + sign * off, 0, last)] == ids[np.clip(b[rows, None] + sign * off, 0, last)]
            equal &= off < limit[rows, None]
            n = np.where(equal.all(axis=1), step, equal.argmin(axis=1))
            out[rows] += n
            further.append(rows[(n == step) & (out[rows] < limit[rows])])
        todo = np.concatenate(further)
        step = min(step * 2, 1 << 16)
    return out


def _blocks(ids: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix array of the places whose first ``least`` words are repeated, and the repeated blocks.

    The blocks of a level are m, place, low, high: the block's interval of the array.
    """
    n = len(ids)
    rank, known = ids.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.concatenate(([True], rank[order[1:]] != rank[order[:-1]]))
        if known >= least:
            break
        named = np.cumsum(new) - 1
        rank[order] = named
        rank[: n - known] = rank[: n - known] * (n + 1) + rank[known:] + 1
        rank[n - known :] *= n + 1
        known *= 2
    open_ = ~(new & np.append(new[1:], True))
    sa, new = order[open_], new[open_]
    m = len(sa)
    head = np.maximum.accumulate(np.where(new, np.arange(m), 0))
    rank = np.arange(m, m + n)
    rank[sa] = head
    levels, slots = [], np.arange(m)
    while len(slots) and known <= longest:
        place = sa[slots]
        own = head[slots]
        size = np.bincount(own, minlength=m)
        block = place % known == 0
        levels.append((known, place[block], own[block], own[block] + size[own[block]]))
        behind = place + known
        tail = np.where(behind < n, rank[np.minimum(behind, n - 1)], m + n)
        key = own * (m + n + 1) + tail
        order = np.argsort(key)
        key, place = key[order], place[order]
        sa[slots] = place
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.append(new[1:], True)
        head[slots] = first
        rank[place] = np.where(alone, m + place, first)
        slots = slots[~alone]
        known *= 2
    return sa, levels


def _candidates(ids: np.ndarray, tree: WaveletTree, m: int, at: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> Iterator[tuple]:
    """Places and candidate periods of the blocks of a level."""
    n = np.int64(len(ids))
    if m == least:
        below, end = tree.less(low, high, np.minimum(at + 1, n)), tree.less(low, high, np.minimum(at + m, n))
        some = end > below
        yield at[some], tree.nth(low[some], high[some], below[some]) - at[some]
    below, end = tree.less(low, high, np.minimum(at + m, n)), tree.less(low, high, np.minimum(at + 2 * m, n))
    some = end > below
    at, low, high, below, end = at[some], low[some], high[some], below[some], end[some]
    first, last = tree.nth(low, high, below), tree.nth(low, high, end - 1)
    few = end - below <= 2
    yield at[few], first[few] - at[few]
    two = end - below == 2
    yield at[two], last[two] - at[two]
    if few.all():
        return
    at, first, last, low, high, below = (x[~few] for x in (at, first, last, low, high, below))
    own = tree.nth(low, high, below + 1) - first
    limit = np.full(len(at), 3 * m)
    right, right_copy = (x + m + _agreeing(ids, x + m, x + m - own, limit) for x in (at, last))
    left, left_copy = (x - _agreeing(ids, x - 1, x - 1 + own, limit, -1) for x in (at, first))
    for period in (right_copy - right, left_copy - left):
        fits = (period >= m) & (period < 2 * m)
        place, shift = at[fits], period[fits]
        holds = _agreeing(ids, place, place + shift, np.full(len(place), m)) == m
        yield place[holds], shift[holds]


def _maximal(ids: np.ndarray, at: np.ndarray, period: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, length and period of the maximal stretches in which the words at ``at`` agree with those a period on."""
    if not len(at):
        return at, at, at
    order = np.lexsort((size, at, period))
    at, period, size = at[order], period[order], size[order]
    apart = period * (4 * len(ids))
    end = np.maximum.accumulate(at + size + apart) - apart
    same = period[1:] == period[:-1]
    gap = np.full(len(at), len(ids))
    gap[:-1][same] = np.maximum(0, at[1:] - end[:-1])[same]
    far = _agreeing(ids, end, end + period, gap)
    joined = np.concatenate(([False], same & (far[:-1] >= gap[:-1])))
    begins = np.flatnonzero(~joined)
    ends = np.append(begins[1:], len(at)) - 1
    back = _agreeing(ids, at[begins] - 1, at[begins] - 1 + period[begins], np.full(len(begins), len(ids)), -1)
    start = at[begins] - back
    period = period[begins]
    return start, end[ends] + far[ends] + period - start, period


def find_runs(ids: np.ndarray, longest: int, shortest: int = SHORTEST, power: int = POWER) -> tuple[np.ndarray, ...]:
    """Start, length and smallest period of the maximal runs of at least ``shortest`` and ``power`` periods.

    ``ids`` begins and ends with a number that occurs once, and so has one between texts; ``longest``
    bounds the words of a text.
    """
    if power < 3:
        raise ValueError("runs of fewer than three periods need other blocks")
    least = 1
    while 3 * (2 * least) - 2 <= shortest:
        least *= 2
    empty = np.zeros(0, np.int64)
    if longest < shortest:
        return empty, empty, empty
    sa, levels = _blocks(ids, least, max(least, longest // power))
    if not len(sa):
        return empty, empty, empty
    tree = WaveletTree(sa, len(ids).bit_length())
    found = []
    for m, *blocks in levels:
        for place, period in _candidates(ids, tree, m, *blocks, least):
            found.append((place, period, np.full(len(place), m)))
    start, length, period = _maximal(ids, *(np.concatenate(c) for c in zip(*found, strict=True)))
    good = (length >= shortest) & (length >= power * period)
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[new], length[new], period[new]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _collapsed(raw: bytes, n: int, runs: list[tuple[int, int, int]]) -> bytes:
    """The n words of the text without those that a run holds behind its first period."""
    gone = np.zeros(n + 1, np.int32)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = (np.cumsum(gone[:-1]) == 0) if runs else None
    parts, at = [], 0
    for piece in pieces(raw):
        words = piece.split()
        kept = words if keep is None else list(itertools.compress(words, keep[at : at + len(words)].tolist()))
        at += len(words)
        if kept:
            parts.append(b" ".join(kept))
    return b" ".join(parts)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def periodic_runs(documents: DataFrame, shortest: int = SHORTEST, power: int = POWER) -> DataFrame:
    """doc_id, n_words, runs and collapsed of every document.

    Runs are structs of start (number of the first word), length and smallest period in words, by start
    and period. The collapsed text has the words, joined by one space, but for those that any run holds
    behind its first period.
    """
    prepare(documents.sparkSession)

    def search(texts: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
        number, parts, begins, n = _Numbers(), [], [], 1
        for _, raw in texts:
            begins.append(n)
            for piece in pieces(raw):
                words = piece.split()
                parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                n += len(words)
            parts.append(np.full(1, -1, np.int32))
            n += 1
        ids = np.concatenate([np.full(1, -1, np.int32), *parts])
        seps = np.flatnonzero(ids < 0)
        ids[seps] = len(number) + np.arange(len(seps))
        ends = [*(b - 1 for b in begins[1:]), n - 1]
        longest = max(e - b for b, e in zip(begins, ends, strict=True))
        start, length, period = find_runs(ids, longest, shortest, power)
        cuts = np.searchsorted(start, [*begins, n]).tolist()
        rows = []
        for k, (doc_id, raw) in enumerate(texts):
            own = slice(cuts[k], cuts[k + 1])
            runs = list(zip((start[own] - begins[k]).tolist(), length[own].tolist(), period[own].tolist(), strict=True))
            runs.sort(key=lambda r: (r[0], r[2]))
            named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
            n_words = ends[k] - begins[k]
            rows.append((doc_id, n_words, named, _collapsed(raw, n_words, runs)))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [*_ROWS.types[:3], pa.binary()], strict=True)]
        return pa.RecordBatch.from_arrays([*columns[:3], columns[3].cast(pa.string())], schema=_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode()
                texts.append((doc_id, raw))
                held += len(raw) // 6 + 1
                if held >= TOGETHER:
                    yield search(texts)
                    texts, held = [], 0
        if texts:
            yield search(texts)

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def greatest_run(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; ties go to the smallest start, then period; null without runs."""

    def better(best: Column, run: Column) -> Column:
        left, right = run["length"] * best["period"], best["length"] * run["period"]
        tied = (left == right) & ((run["start"] < best["start"]) | (run["start"] == best["start"]) & (run["period"] < best["period"]))
        return F.when(best.isNull() | (left > right) | tied, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def runs_digest(runs: Column) -> Column:
    """SHA-256 of a line ``start,length,period`` per run."""
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(runs, line), ""), 256)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text, by a checksum of its id, becomes periodic from some word on.

    With h the CRC-32 of the decimal id, g = h / 10 and n words, texts with h % 10 = 0 and words repeat
    the p words from word a on, where a = g % n and p = 1 + (n - a) / (3 + g % 8), in whole numbers.
    Texts without an id stay as they are.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    words = F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = rows.withColumn("_words", words).withColumn("_n", F.when(F.size("_words") > 0, F.size("_words")))
    rows = rows.withColumn("_g", F.floor(F.col("_h") / 10)).withColumn("_a", F.expr("cast(_g % _n as int)"))
    rows = rows.withColumn("_times", F.expr("cast(3 + _g % 8 as int)")).withColumn("_p", F.expr("1 + (_n - _a) div _times"))
    tail = "slice(flatten(array_repeat(slice(_words, _a + 1, cast(_p as int)), _times + 1)), 1, _n - _a)"
    text = F.when(F.col("_n") > 0, F.expr(f"array_join(concat(slice(_words, 1, _a), {tail}), ' ')")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
