"""Benchmark decontamination by SimHash of item-sized windows (operator 7).

Every window of a document that is as long as a benchmark item gets a 64-bit SimHash of its word
shingles. The items' fingerprints are cut into blocks, and a table lists for every value of a block
the items within its share of the radius: of two fingerprints within the radius one block at least
is that near, so no such fingerprint is missed (multi-index Hamming search). Candidates are verified
by the weighted share of the item's shingles that the window holds.

The radius does not bound that share, as foreign words of a window move its fingerprint and not the
share. So a list of the items of every shingle gives the items of which the document holds enough at
all, and where windows gain or lose one of an item's shingles they are verified too, those that hold
most first. That search is exact: no item of enough similarity depends on the radius.

A window cannot hold more of an item than the shingles in it that occur in the benchmark at all.
Fingerprints are only made where those weigh enough for the lightest item of the window's length;
that bound is exact and spares most of the text the rest.

Shingles take five words in lower case without marks (an item of fewer words is one shingle) and
weigh as much as they have characters. The benchmark goes to the tasks in blocks of ``ITEMS`` items,
one after another, so what a task holds does not grow with it.

Nulls and ties: null texts have no words; items without words match nothing; an item without an
item_id matches with a null one; repeated items match each. Of equally similar windows of a
document and item the first counts. A document shorter than an item is one window. Rows without a
doc_id are scanned like others. Columns beyond the ids and texts pass through ``clean_documents``
untouched. Empty tables give no matches.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.quality import plain_words
from rowtide.llm.shared import prepare

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
#: Items a task holds at once.
ITEMS = 1_000
_BITS = 64 // BLOCKS
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the factor and its inverse, longer as longer texts come."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            cls.up, cls.down = _powers(_FACTOR, 2 * n), _powers(_INVERSE, 2 * n)
        return cls.up, cls.down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a text and, for any shingle length, hashes and sizes of its shingles."""

    def __init__(self, text: str | None):
        self.words = plain_words(text or "")
        self.joined = b" ".join(self.words)
        n = len(self.joined)
        up, _ = _Powers.of(n + 1)
        data = np.frombuffer(self.joined, np.uint8)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[:n], out=self.prefix[1:])
        gaps = np.flatnonzero(data == 32)
        some = len(self.words) > 0
        self.begin = np.concatenate(([0], gaps + 1)) if some else np.zeros(0, np.int64)
        self.end = np.append(gaps, n) if some else np.zeros(0, np.int64)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        begin, end = self.begin[: len(self.words) - size + 1], self.end[size - 1 :]
        _, down = _Powers.of(len(self.joined) + 1)
        return _mixed((self.prefix[end] - self.prefix[begin]) * down[begin]), end - begin

    def shingle(self, at: int, size: int) -> bytes:
        return self.joined[self.begin[at] : self.end[at + size - 1]]


def _signs(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted +1 or -1 per bit of each shingle."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits.astype(np.int32) * 2 - 1) * weights[:, None].astype(np.int32)


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def simhash(hashes: np.ndarray, weights: np.ndarray) -> int:
    return int(_packed(_signs(hashes, weights).sum(axis=0, dtype=np.int64)[None])[0])


def _near_values(radius: int) -> np.ndarray:
    """All differences of a block within the radius."""
    every = np.arange(1 << _BITS, dtype=np.uint32)
    return every[np.bitwise_count(every) <= radius]


class Index:
    """The items of a block of the benchmark, as a task searches them."""

    def __init__(self, items: list[tuple[int | None, str | None]], radius: int):
        self.radius = radius
        kept = [(item_id, Words(text)) for item_id, text in items]
        self.items = [(item_id, words) for item_id, words in kept if words.words]
        self.sizes = np.array([len(w.words) for _, w in self.items], np.int64)
        self.shingle = np.minimum(self.sizes, SHINGLE)
        fps, known, owner, worth = [], {}, {}, {}
        self.content: list[Counter] = []
        self.weight: list[int] = []
        for i, ((_, words), size) in enumerate(zip(self.items, self.shingle.tolist(), strict=True)):
            hashes, weights = words.shingles(size)
            fps.append(simhash(hashes, weights))
            known.setdefault(size, []).append(hashes)
            owner.setdefault(size, []).append(np.full(len(hashes), i, np.int64))
            worth.setdefault(size, []).append(weights)
            content = Counter(words.shingle(i, size) for i in range(len(hashes)))
            self.content.append(content)
            self.weight.append(sum(len(s) * n for s, n in content.items()))
        weight = np.array(self.weight, np.int64)
        self.least = {n: max(1, int(weight[self.sizes == n].min())) for n in set(self.sizes.tolist())}
        self.fps = np.array(fps, np.uint64)
        self.known = {size: np.unique(np.concatenate(h)) for size, h in known.items()}
        self.postings = {size: self._posted(size, *map(np.concatenate, (known[size], owner[size], worth[size]))) for size in known}
        self.flags = {}
        for size, hashes in self.known.items():
            self.flags[size] = np.zeros(1 << 20, bool)
            self.flags[size][hashes & np.uint64((1 << 20) - 1)] = True
        self.tables = []
        near = _near_values(radius // BLOCKS)
        for block in range(BLOCKS):
            value = ((self.fps >> np.uint64(block * _BITS)) & np.uint64((1 << _BITS) - 1)).astype(np.uint32)
            keys = (value[:, None] ^ near[None]).ravel()
            order = np.argsort(keys, kind="stable")
            item = np.repeat(np.arange(len(value), dtype=np.int32), len(near))[order]
            self.tables.append((np.searchsorted(keys[order], np.arange((1 << _BITS) + 1)), item))

    def _posted(self, size: int, hashes: np.ndarray, owner: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, ...]:
        """Shingle (its place among the known), item and weight of every shingle in every item; and where an item's begin."""
        pair, of = np.unique(np.searchsorted(self.known[size], hashes) + owner * len(self.known[size]), return_inverse=True)
        item, shingle = pair // len(self.known[size]), pair % len(self.known[size])
        weight = np.bincount(of, worth, len(pair)).astype(np.int64)
        return shingle, item, weight, np.searchsorted(item, np.arange(len(self.items) + 1))

    def held_windows(
        self, hashes: np.ndarray, weights: np.ndarray, hits: np.ndarray, size: int, similarity: float
    ) -> Iterator[tuple[int, int, list[tuple[float, int]]]]:
        """item, its window's shingles, and windows that may hold enough of it: the most they can hold and their place, best first.

        What a window holds of an item changes only where the window gains or loses one of its
        shingles, so the first window of every value is among those that begin there.
        """
        shingle, item, weight, begin = self.postings[size]
        place = np.searchsorted(self.known[size], hashes[hits])
        total = np.bincount(place, weights[hits], len(self.known[size])).astype(np.int64)
        most = np.bincount(item, np.minimum(total[shingle], weight), len(self.items))
        whole = np.array(self.weight, np.float64)
        for i in np.flatnonzero((most / whole >= similarity) & (self.shingle == size)).tolist():
            span = min(int(self.sizes[i]), len(hashes) + size - 1) - size + 1
            own = np.zeros(len(total), bool)
            own[shingle[begin[i] : begin[i + 1]]] = True
            at = hits[own[place]]
            sums = np.concatenate(([0], np.cumsum(weights[at])))
            starts = np.unique(np.concatenate(([0], at + 1, np.maximum(at - span + 1, 0))))
            starts = starts[starts <= len(hashes) - span]
            held = (sums[np.searchsorted(at, starts + span)] - sums[np.searchsorted(at, starts)]) / whole[i]
            some = np.flatnonzero(held >= similarity)
            some = some[np.argsort(-held[some], kind="stable")]
            if len(some):
                yield i, span, list(zip(held[some].tolist(), starts[some].tolist(), strict=True))

    def hits(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Places of the shingles that some item has."""
        maybe = np.flatnonzero(self.flags[size][hashes & np.uint64((1 << 20) - 1)])
        known = self.known[size]
        at = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        return maybe[known[at] == hashes[maybe]]

    def near_items(self, fps: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a window and one of these items (a flag each) within the radius."""
        pairs = []
        for block, (start, item) in enumerate(self.tables):
            value = ((fps >> np.uint64(block * _BITS)) & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            many = start[value + 1] - start[value]
            window = np.repeat(np.arange(len(fps)), many)
            place = np.repeat(start[value] - (np.cumsum(many) - many), many) + np.arange(len(window))
            found = item[place]
            asked = among[found]
            window, found = window[asked], found[asked]
            close = np.bitwise_count(fps[window] ^ self.fps[found]) <= self.radius
            pairs.append(window[close] * len(self.fps) + found[close])
        pair = np.unique(np.concatenate(pairs))
        return pair // len(self.fps), pair % len(self.fps)

    def matches(self, text: str | None, similarity: float) -> list[tuple[int, float, int, int, int]]:
        """item, similarity, first word, words and Hamming distance of each item's best window."""
        if not self.items:
            return []
        words, best = Words(text), {}
        n = len(words.words)
        for size in self.known:
            if n < size:
                continue
            hashes, weights = words.shingles(size)
            hits = self.hits(hashes, size)
            if not len(hits):
                continue
            sums = None
            held = np.zeros(len(hashes) + 1, np.int64)
            held[hits + 1] = weights[hits]
            held = np.cumsum(held)
            for length in np.unique(self.sizes[self.shingle == size]).tolist():
                span = min(length, n) - size + 1
                among = (self.sizes == length) & (self.shingle == size)
                windows = np.flatnonzero(held[span:] - held[: len(held) - span] >= similarity * self.least[length])
                if not len(windows):
                    continue
                if sums is None:
                    sums = _Sums(hashes, weights, hits, int(min(self.sizes.max(), n)))
                for at in range(0, len(windows), 4096):
                    some = windows[at : at + 4096]
                    window, item = self.near_items(sums.fingerprints(some, span), among)
                    for w, i in zip(some[window].tolist(), item.tolist(), strict=True):
                        found = self.similarity(words, w, span, size, i)
                        if found >= similarity and found > best.get(i, (0.0,))[0]:
                            fp = simhash(hashes[w : w + span], weights[w : w + span])
                            best[i] = (found, w, min(length, n), (fp ^ int(self.fps[i])).bit_count())
            for i, span, some in self.held_windows(hashes, weights, hits, size, similarity):
                for most, w in some:
                    found, first = best.get(i, (0.0, n))[:2]
                    if (-most, w) >= (-found, first):
                        break
                    share = self.similarity(words, w, span, size, i)
                    if share >= similarity and (-share, w) < (-found, first):
                        fp = simhash(hashes[w : w + span], weights[w : w + span])
                        best[i] = (share, w, span + size - 1, (fp ^ int(self.fps[i])).bit_count())
        return [(i, *found) for i, found in sorted(best.items())]

    def similarity(self, words: Words, at: int, span: int, size: int, item: int) -> float:
        window = Counter(words.shingle(k, size) for k in range(at, at + span))
        content = self.content[item]
        return sum(len(s) * min(k, window[s]) for s, k in content.items() if s in window) / self.weight[item]


class _Sums:
    """Running sums of the bits' signs over the stretches around hits, for windows of any length."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, hits: np.ndarray, reach: int):
        self.hashes, self.weights = hashes, weights
        low = np.maximum(hits - reach, 0)
        high = np.minimum(hits + reach + 1, len(hashes))
        cut = np.concatenate(([True], low[1:] > high[:-1]))
        first = np.flatnonzero(cut)
        self.low, self.high = low[first], high[np.append(first[1:], len(hits)) - 1]
        self.made: dict[int, np.ndarray] = {}

    def fingerprints(self, windows: np.ndarray, span: int) -> np.ndarray:
        out = np.empty(len(windows), np.uint64)
        part = np.searchsorted(self.low, windows, side="right") - 1
        for k in np.unique(part).tolist():
            low, high = int(self.low[k]), int(self.high[k])
            sums = self.made.get(k)
            if sums is None:
                signs = _signs(self.hashes[low:high], self.weights[low:high])
                sums = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(signs, axis=0, dtype=np.int64)))
                self.made = {k: sums}
            own = part == k
            at = windows[own] - low
            out[own] = _packed(sums[at + span] - sums[at])
        return out


_INDEXES: dict[str, Index] = {}


def _index(name: str, items: list, radius: int) -> Index:
    """Built once per worker process; the one before it is let go."""
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = Index(items, radius)
    return _INDEXES[name]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items, ITEMS or so at a time."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    n = -(-items.count() // ITEMS)
    block = F.pmod(F.xxhash64("item_id", "text"), n) if n > 1 else F.lit(0)
    items = items.withColumn("block", block)
    for k in range(n):
        yield [(r.item_id, r.text) for r in items.where(F.col("block") == k).collect()]


_FOUND = "item_id long, similarity double, first_word long, n_words long, distance int"


def contaminations(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words, distance of every document and item that match."""
    spark = prepare(documents.sparkSession)
    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for items in _blocks(benchmark):
        found = chosen.mapInArrow(_scan(items, similarity, radius), f"doc_id long, {_FOUND}")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"doc_id long, {_FOUND}")


def _scan(items: list, similarity: float, radius: int):
    name = uuid.uuid4().hex
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
    names = ["doc_id", "item_id", "similarity", "first_word", "n_words", "distance"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(name, items, radius)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for item, *found in index.matches(text.as_py(), similarity):
                    rows.append((doc_id, index.items[item][0], *found))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return scan


def clean_documents(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The documents in which no item is found, with their own columns."""
    prepare(documents.sparkSession)
    text = documents.columns.index("text")
    kept = documents
    for items in _blocks(benchmark):
        kept = kept.mapInArrow(_keep(items, text, similarity, radius), documents.schema)
    return kept


def _keep(items: list, text: int, similarity: float, radius: int):
    name = uuid.uuid4().hex

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(name, items, radius)
        for batch in batches:
            texts = batch.column(text).cast(pa.string())
            yield batch.filter(pa.array([not index.matches(t.as_py(), similarity) for t in texts], pa.bool_()))

    return keep
