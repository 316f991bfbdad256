"""Repeated word windows within and across documents, by fixed-block anchors (operator 11).

A window of ``window`` words holds at least one whole block of half that size of its document's grid
of non-overlapping blocks. So the blocks are the index, and every rolling run of a block's length is
a probe. A window that is repeated has a block that is also probed from somewhere else:

1. Tasks write the texts to slice files in the shared folder and give the hashes of their probes, once
   per slice and with marks for blocks and repeats, in one packed row per lot of hashes.
2. A lot tells each slice by a bit per hash which of its probes hit a block and are not alone, and
   by another which of those are at over ``capacity`` places.
3. The tasks of the slices cut out the words around their hits, a context each. Equal contexts are
   one row with a count from then on, and each carries its words once per slice.
4. All contexts of a block meet, and every hit is extended word by word, to the left by each length
   and to the right as far as any partner goes. Sorting by the words to the right within equal left
   sides puts the partner of longest extension beside it, so no pairs are listed.
5. The windows inside the maximal repeats go back to the places, and the words they cover are removed.

Hashes of probes only nominate (32 bits within a lot); what is repeated is decided on the words. A
block at over ``capacity`` places has no contexts: it is taken apart into its single windows, which
are counted by a 128-bit hash each: packed by slice and lot of hashes, once per slice, without a row
a place and without any task that holds the block's rows.

Lots are as many as the corpus needs to keep each below a set size. Long texts are handled in pieces
cut at white space; a slice with one long text holds 8 bytes a word and some arrays of that size.

Nulls and ties: a null text has no words. Rows that repeat a document are documents of their own, so
their windows are repeated. Rows without a doc_id are kept. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.shared import drop, file_system, new_file, prepare, shared_folder, stage

WINDOW = 35
#: Bytes of a slice and of a piece of a long text; probes of a lot; contexts searched at once.
SLICE_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
LOT_BYTES = 6 << 20
SEARCHED = 6_000
#: Places of a block beyond which its windows are counted singly.
CAPACITY = 6_000
#: Words whose hash a worker remembers.
REMEMBERED = 500_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SLICE = pa.schema([("doc_id", pa.int64()), ("first", pa.bool_()), ("text", pa.binary())])
_Piece = tuple[int | None, bool, list[bytes]]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def pieces(raw: bytes) -> Iterator[bytes]:
    """The text in parts of about PIECE_BYTES, cut where a word ends; bytes.split knows no other white space."""
    begin = 0
    while True:
        end = _SPACE.search(raw, begin + PIECE_BYTES)
        if end is None:
            yield raw[begin:]
            return
        yield raw[begin : end.start()]
        begin = end.end()


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * np.uint64(0x9E3779B97F4A7C15) + right
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` values, from those of its halves."""
    have, size, done, length = hashes, 1, None, 0
    while True:
        if width & size:
            done, length = (have, size) if done is None else (_mixed(done[: len(have) - length], have[length:]), length + size)
        size *= 2
        if size > width:
            return done
        half = size // 2
        have = _mixed(have[: max(0, len(have) - half)], have[half:])


def probes(hashes: np.ndarray, begins: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the block-long run at every place, and 0 (no probe), 1 (probe) or 2 (also a block).

    ``begins`` has the first word of every document and the number of words. Documents that are
    shorter than a window have neither blocks nor probes.
    """
    block = (window + 1) // 2
    kind = np.zeros(len(hashes), np.uint8)
    if len(hashes) < window:
        return np.zeros(len(hashes), np.uint64), kind
    run = np.zeros(len(hashes), np.uint64)
    run[: len(hashes) - block + 1] = _rolling(hashes, block)
    for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if end - begin >= window:
            kind[begin : end - block + 1] = 1
            kind[begin : end - block + 1 : block] = 2
    return run, kind


def _slice_path(folder: str, name: int) -> str:
    return f"{folder}/slice-{name:016x}.parquet"


def _read_pieces(folder: str, name: int) -> Iterator[_Piece]:
    files, path = file_system(_slice_path(folder, name))
    with files.open_input_file(path) as source:
        for rows in pq.ParquetFile(source).iter_batches(batch_size=64):
            for doc_id, first, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                yield doc_id, first, text.split()


def _hashed(pieces: Iterator[_Piece]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a slice's words, and the first word of every document and the number of words."""
    begins, parts, n = [], [], 0
    for _, first, words in pieces:
        if first:
            begins.append(n)
        parts.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
        n += len(words)
    return np.concatenate([np.zeros(0, np.uint64), *parts]), np.array([*begins, n], np.int64)


def _begins(pieces: Iterator[_Piece]) -> np.ndarray:
    """The first word of every document of a slice, and the number of words."""
    begins, n = [], 0
    for _, first, words in pieces:
        if first:
            begins.append(n)
        n += len(words)
    return np.array([*begins, n], np.int64)


def _keys(run: np.ndarray, lots: int) -> np.ndarray:
    """Lot and 32 further bits of every hash."""
    low = np.uint64(32)
    return (((run >> low) * np.uint64(lots)) >> low) << low | (run & np.uint64(0xFFFFFFFF))


def _distinct(run: np.ndarray, kind: np.ndarray, lots: int) -> tuple[np.ndarray, ...]:
    """The slice's probes as sorted distinct keys, with marks for blocks and the number of places."""
    keys, n = np.unique(_keys(run[kind > 0], lots), return_counts=True)
    block = np.zeros(len(keys), bool)
    block[np.searchsorted(keys, _keys(run[kind == 2], lots))] = True
    return keys, block, n


def slices(documents: DataFrame, folder: str, window: int, lots: int) -> DataFrame:
    """Write the slice files; a row per slice and lot: slice, lot and the packed probes.

    One row of every slice has no lot. A slice is named by the attempt that wrote it, so a repeated
    task leaves files that no row names.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, names = [], 0, itertools.count(TaskContext.get().taskAttemptId() << 20)

        def flush() -> pa.RecordBatch:
            name = next(names)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SLICE.types, strict=True)]
            with new_file(_slice_path(folder, name)) as out:
                stored = pa.Table.from_arrays(columns, schema=_SLICE)
                pq.write_table(stored, out, compression="zstd", use_dictionary=False, row_group_size=4096)
            hashes, begins = _hashed((i, first, text.split()) for i, first, text in rows)
            keys, block, times = _distinct(*probes(hashes, begins, window), lots)
            own, at = np.unique(keys >> np.uint64(32), return_index=True)
            ends = np.append(at, len(keys))[1:]
            sigs, more, times = keys.astype("<u4"), times > 1, times.astype("<u4")
            packed = [
                (int(lot), sigs[a:b].tobytes(), np.packbits(block[a:b]).tobytes(), np.packbits(more[a:b]).tobytes(), times[a:b][more[a:b]].tobytes())
                for lot, a, b in zip(own.tolist(), at.tolist(), ends.tolist(), strict=True)
            ]
            columns = zip((None, b"", b"", b"", b""), *packed, strict=True)
            own = [name] * (1 + len(packed))
            return pa.RecordBatch.from_pydict(dict(zip(_PACKED.names, (own, *columns), strict=True)), schema=_PACKED)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                rows.extend((doc_id, k == 0, piece) for k, piece in enumerate(pieces(raw)))
                held += len(raw)
                if held >= SLICE_BYTES:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(cut, "slice long, lot int, sigs binary, blocks binary, more binary, times binary")


_PACKED = pa.schema(
    [("slice", pa.int64()), ("lot", pa.int32()), ("sigs", pa.binary()), ("blocks", pa.binary()), ("more", pa.binary()), ("times", pa.binary())]
)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def hits(packed: DataFrame, lots: int, capacity: int) -> DataFrame:
    """slice, lot, n, bits and hot: which probes of a slice hit a block and are at two places at least, or at over ``capacity``."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list[tuple[int, bytes, bytes, bytes, bytes]]] = {}
        for batch in batches:
            for name, lot, *data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of.setdefault(lot, []).append((name, *data))
        for lot in list(of):
            rows = of.pop(lot)
            sigs = [np.frombuffer(r[1], "<u4") for r in rows]
            block = np.concatenate([_bits(r[2], len(s)) for r, s in zip(rows, sigs, strict=True)])
            places = np.ones(len(block), np.uint32)
            more = np.concatenate([_bits(r[3], len(s)) for r, s in zip(rows, sigs, strict=True)])
            places[more] = np.frombuffer(b"".join(r[4] for r in rows), "<u4")
            _, group = np.unique(np.concatenate(sigs), return_inverse=True)
            times = np.bincount(group, places)
            hit = (times > 1) & (np.bincount(group, block) > 0)
            hot = (hit & (times > capacity))[group]
            hit, at, out = hit[group], 0, []
            for r, s in zip(rows, sigs, strict=True):
                own, many = hit[at : at + len(s)], hot[at : at + len(s)]
                at += len(s)
                if own.any():
                    out.append((r[0], lot, len(s), np.packbits(own).tobytes(), np.packbits(many).tobytes() if many.any() else None))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(_HITS.names, zip(*out, strict=True), strict=True)), schema=_HITS)

    placed = packed.where("lot is not null").repartitionById(lots, F.col("lot"))
    return placed.mapInArrow(meet, "slice long, lot int, n int, bits binary, hot binary")


_HITS = pa.schema([("slice", pa.int64()), ("lot", pa.int32()), ("n", pa.int32()), ("bits", pa.binary()), ("hot", pa.binary())])


def _hit_places(run: np.ndarray, kind: np.ndarray, lots: int, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the slice whose probes were told to be hits, and those of hot ones."""
    places = np.flatnonzero(kind)
    every = _keys(run[places], lots)
    by = np.argsort(every)
    every = every[by]
    new = np.append(True, every[1:] != every[:-1])[: len(every)]
    keys = every[new]
    told = np.zeros(len(keys), np.int8)
    for lot, n, *bits in zip(*(rows.column(c).to_pylist() for c in ("lot", "n", "bits", "hot")), strict=True):
        at = int(np.searchsorted(keys, np.uint64(lot << 32)))
        for x in filter(None, bits):
            told[at : at + n] += _bits(x, n)
    of = np.empty(len(places), np.int8)
    of[by] = told[np.cumsum(new) - 1]
    return places[of == 1], places[of == 2]


def _contexts(pieces: Iterator[_Piece], places: np.ndarray, begins: np.ndarray, window: int) -> Iterator[tuple[int, int, bytes]]:
    """Place, words before the block and the words around it, of every hit; three pieces are held at most."""
    block = (window + 1) // 2
    side = window - block
    of = np.searchsorted(begins, places, side="right") - 1
    low = np.maximum(places - side, begins[of])
    high = np.minimum(places + block + side, begins[of + 1])
    held: list[bytes] = []
    base = k = 0
    todo = list(zip(places.tolist(), low.tolist(), high.tolist(), strict=True))
    for _, _, words in pieces:
        held += words
        end = base + len(held)
        while k < len(todo) and todo[k][2] <= end:
            place, a, b = todo[k]
            yield place, place - a, b" ".join(held[a - base : b - base])
            k += 1
        if len(held) > 4 * window:
            gone = len(held) - 2 * window
            gone = min(gone, todo[k][1] - base) if k < len(todo) else gone
            held, base = held[gone:], base + gone


def contexts(found: DataFrame, folder: str, window: int, lots: int) -> DataFrame:
    """slice, at and cid of every context; h, lead, its number of places and its words once per slice and context.

    Rows with a lot have the packed windows around hot places instead, as ``window_hashes`` gives them.
    """

    def cut(rows: pa.Table) -> pa.Table:
        name = rows.column("slice")[0].as_py()
        hashes, begins = _hashed(_read_pieces(folder, name))
        run, kind = probes(hashes, begins, window)
        places, hot = _hit_places(run, kind, lots, rows)
        first: dict[bytes, int] = {}
        leads, cids, times, data = [], [], [], []
        for k, (_, lead, words) in enumerate(_contexts(_read_pieces(folder, name), places, begins, window)):
            cid = xxhash.xxh3_128_digest(words, lead)
            of = first.setdefault(cid, k)
            cids.append(cid)
            for column, value in ((leads, lead), (times, 0), (data, words)):
                column.append(value if of == k else None)
            times[of] += 1
        h = pa.array(run[places].view(np.int64), mask=np.array([n is None for n in times], bool))
        columns = [pa.array(c, t) for c, t in zip((cids, leads, times, data), _PLACED.types[3:], strict=True)]
        single = pa.Table.from_arrays([pa.array(np.full(len(cids), name, np.int64)), pa.array(places), h, *columns], schema=_PLACED)
        windows = _packed_windows(folder, name, _around(hot, begins, window), window, lots)
        return pa.concat_tables([single, windows], promote_options="default")

    # A set number of tasks: the bits are few bytes, which would else end up in one task, and each slice is read again.
    dealt = found.repartition(lots, "slice")
    columns = "slice long, at long, h long, cid binary, lead int, n long, data binary, lot int, sigs binary, times binary, places binary"
    return dealt.groupBy("slice").applyInArrow(cut, columns)


_PLACED = pa.schema(
    [
        ("slice", pa.int64()), ("at", pa.int64()), ("h", pa.int64()), ("cid", pa.binary()), ("lead", pa.int32()), ("n", pa.int64()),
        ("data", pa.binary()),
    ]
)


def extended(group: np.ndarray, leads: list[int], data: list[bytes], window: int) -> np.ndarray:
    """Per context a bit for every o: the window that starts o words before its block is repeated.

    Contexts of a group have the same block and are distinct. For every o, those with equal o words
    before the block are sorted by the words behind it; the longest extension of a hit to the right
    is that with one of its two neighbours there.
    """
    block = (window + 1) // 2
    side = window - block
    n = len(leads)
    number: dict[bytes, int] = {}
    left = np.arange(-1, -n * side - 1, -1).reshape(n, side)  # a number of its own where a text has no word
    right = left - n * side
    for i, (lead, text) in enumerate(zip(leads, data, strict=True)):
        ids = [number.setdefault(w, len(number)) for w in text.split(b" ")]
        left[i, :lead] = ids[:lead][::-1]
        right[i, : len(ids) - lead - block] = ids[lead + block :]
    order = np.lexsort((*right.T[::-1], group))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    _, same = np.unique(group, return_inverse=True)
    out = np.zeros(n, np.int64)
    for o in range(side + 1):
        if o:
            key = same * (left[:, o - 1].max() - left.min() + 2) + (left[:, o - 1] - left.min())
            _, same = np.unique(key, return_inverse=True)
        by = np.argsort(same * n + place)
        a, b = by[:-1], by[1:]
        reach = np.logical_and.accumulate(right[a, : side - o] == right[b, : side - o], axis=1)
        far = (same[a] == same[b]) & (reach.sum(axis=1) >= side - o)
        out[a[far]] |= 1 << o
        out[b[far]] |= 1 << o
    return out


def _valid(lead: int, n_words: int, window: int) -> int:
    """A bit for every o such that the window o words before the block lies inside the context."""
    return sum(1 << o for o in range(min(lead, window // 2) + 1) if n_words - lead + o >= window)


def extend(parts: DataFrame, window: int) -> DataFrame:
    """cid, mask: the repeated windows of the contexts (h, cid, n, lead, data, a row per slice) that have any."""
    schema = pa.schema([("cid", pa.binary()), ("mask", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids: list[bytes] = []
        masks: list[int] = []
        groups, group, held = [], [], 0

        def search() -> None:
            rows = [r for g in groups for r in g]
            of = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
            found = extended(of, [r[3] for r in rows], [r[4] for r in rows], window)
            for row, mask in zip(rows, found.tolist(), strict=True):
                mask = _valid(row[3], row[4].count(b" ") + 1, window) if row[2] > 1 else mask
                if mask:
                    cids.append(row[1])
                    masks.append(mask)

        def close() -> int:
            if len(group) > 1:
                groups.append(group)
                return len(group)
            if group and group[0][2] > 1:
                _, cid, _, lead, words = group[0]
                if mask := _valid(lead, words.count(b" ") + 1, window):
                    cids.append(cid)
                    masks.append(mask)
            return 0

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    held += close()
                    group = []
                    if held >= SEARCHED:
                        search()
                        groups, held = [], 0
                group.append(row)
            if len(cids) >= 4096:
                yield pa.RecordBatch.from_pydict({"cid": cids, "mask": masks}, schema=schema)
                cids, masks = [], []
        close()
        if groups:
            search()
        yield pa.RecordBatch.from_pydict({"cid": cids, "mask": masks}, schema=schema)

    # One shuffle for both: what is dealt by h is also together by h and cid.
    distinct = parts.repartition("h").groupBy("h", "cid").agg(
        F.sum("n").alias("n"), F.any_value("lead").alias("lead"), F.any_value("data").alias("data")
    )
    return distinct.sortWithinPartitions("h", "cid").mapInArrow(run, "cid binary, mask long")


_WINDOWS = pa.schema(
    [("slice", pa.int64()), ("lot", pa.int32()), ("sigs", pa.binary()), ("times", pa.binary()), ("places", pa.binary())]
)
_STARTS = pa.schema([("slice", pa.int64()), ("starts", pa.binary())])


def _around(places: np.ndarray, begins: np.ndarray, window: int) -> np.ndarray:
    """Where the windows begin that hold a block at one of the places."""
    of = np.searchsorted(begins, places, side="right") - 1
    first = np.maximum(places - window // 2, begins[of])
    end = np.minimum(places, begins[of + 1] - window) + 1
    some = first < end
    edge = np.zeros(begins[-1] + 1, np.int64)
    np.add.at(edge, first[some], 1)
    np.add.at(edge, end[some], -1)
    return np.flatnonzero(np.cumsum(edge) > 0)


def _digests(pieces: Iterator[_Piece], starts: list[int], window: int) -> Iterator[bytes]:
    """128-bit hash of the words of every window; a piece and a window's words are held at most."""
    held: list[bytes] = []
    base = k = 0
    for _, _, words in pieces:
        held += words
        while k < len(starts) and starts[k] + window <= base + len(held):
            at = starts[k] - base
            yield xxhash.xxh3_128_digest(b" ".join(held[at : at + window]))
            k += 1
        if k == len(starts):
            return
        gone = min(len(held), starts[k] - base)
        held, base = held[gone:], base + gone


def _packed_windows(folder: str, name: int, starts: np.ndarray, window: int, lots: int) -> pa.Table:
    """slice, lot, sigs, times and places of the windows that begin there: a hash once with its number of places."""
    if not len(starts):
        return _WINDOWS.empty_table()
    sigs = np.frombuffer(b"".join(_digests(_read_pieces(folder, name), starts.tolist(), window)), "<u8").reshape(-1, 2)
    by = np.lexsort((sigs[:, 1], sigs[:, 0]))
    sigs, starts = sigs[by], starts[by].astype("<i8")
    new = np.flatnonzero(np.append(True, (sigs[1:] != sigs[:-1]).any(axis=1)))
    sigs, ends = sigs[new], np.append(new, len(starts))
    times = np.diff(ends).astype("<u4")
    own, first = np.unique(((sigs[:, 0] >> np.uint64(32)) * np.uint64(lots)) >> np.uint64(32), return_index=True)
    cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(sigs)], strict=True))
    packed = [[x[a:b].tobytes() for a, b in cuts] for x in (sigs, times)]
    columns = [[name] * len(own), own.astype(np.int32), *packed, [starts[ends[a] : ends[b]].tobytes() for a, b in cuts]]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _WINDOWS.types, strict=True)], schema=_WINDOWS)


def window_hashes(places: DataFrame, folder: str, window: int, lots: int) -> DataFrame:
    """slice, lot, sigs, times, places: 128-bit hashes and places of the windows around hits (slice, at), packed by lot."""

    def cut(rows: pa.Table) -> pa.Table:
        name = rows.column("slice")[0].as_py()
        at = np.unique(rows.column("at").to_numpy())
        return _packed_windows(folder, name, _around(at, _begins(_read_pieces(folder, name)), window), window, lots)

    dealt = places.select("slice", "at").repartition(lots, "slice")
    return dealt.groupBy("slice").applyInArrow(cut, "slice long, lot int, sigs binary, times binary, places binary")


def repeated_starts(windows: DataFrame, lots: int) -> DataFrame:
    """slice, starts: where repeated windows begin, each of the packed windows counted by itself.

    All windows of a hash are in its lot, as 20 packed bytes for each slice and 8 for each place, and go back
    as 8 packed bytes in a row per slice and lot: no row a window, and no join on a window that very many
    places have.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list[tuple[int, bytes, bytes, bytes]]] = {}
        for batch in batches:
            for name, lot, *data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of.setdefault(lot, []).append((name, *data))
        for lot in list(of):
            rows = of.pop(lot)
            sigs = np.frombuffer(b"".join(r[1] for r in rows), "<u8").reshape(-1, 2)
            repeated = np.frombuffer(b"".join(r[2] for r in rows), "<u4") > 1
            by = np.lexsort((sigs[:, 1], sigs[:, 0]))
            equal = (sigs[by[1:]] == sigs[by[:-1]]).all(axis=1)
            repeated[by[1:][equal]] = repeated[by[:-1][equal]] = True
            names, starts, end = [], [], 0
            for name, _, times, packed in rows:
                times, at = np.frombuffer(times, "<u4"), np.frombuffer(packed, "<i8")
                begin, end = end, end + len(times)
                at = at[np.repeat(repeated[begin:end], times)]
                if len(at):
                    names.append(name)
                    starts.append(at.tobytes())
            if names:
                yield pa.RecordBatch.from_pydict({"slice": names, "starts": starts}, schema=_STARTS)

    windows = windows.select("slice", "lot", "sigs", "times", "places")
    return windows.repartitionById(lots, F.col("lot")).mapInArrow(meet, "slice long, starts binary")


def single_windows(places: DataFrame, folder: str, window: int, lots: int) -> DataFrame:
    """slice, at, mask: the repeated windows around hits (slice, at), a row each."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.frombuffer(starts, "<i8")
                columns = [np.full(len(at), name, np.int64), at, np.ones(len(at), np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slice", "at", "mask"])

    windows = stage(window_hashes(places, folder, window, lots))
    return repeated_starts(windows, lots).mapInArrow(spread, "slice long, at long, mask long")


def repeats(documents: DataFrame, folder: str, window: int = WINDOW, capacity: int = CAPACITY) -> DataFrame:
    """slice, at, mask, starts: bit o says that the window o words before ``at`` is repeated.

    ``starts`` are packed places where others begin. Every slice has a row of nulls.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    lots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // LOT_BYTES))
    packed = stage(slices(documents, folder, window, lots))
    none = F.lit(None).cast("long")
    marks = packed.where("lot is null").select("slice", none.alias("at"), none.alias("mask"))
    marks = stage(marks)
    found = stage(hits(packed, lots, capacity))
    drop(packed)
    told = stage(contexts(found, folder, window, lots))
    placed = told.where("lot is null")
    verdict = extend(placed.where("n is not null").select("h", "cid", "n", "lead", "data"), window)
    out = placed.select("slice", "at", "cid").join(verdict, "cid").select("slice", "at", "mask").unionByName(marks)
    singly = repeated_starts(told.where("lot is not null"), lots)
    return out.unionByName(singly, allowMissingColumns=True)


def _covered(n: int, at: np.ndarray, mask: np.ndarray, window: int) -> np.ndarray:
    """Which words of a slice the windows cover."""
    edge = np.zeros(n + 1, np.int64)
    for o in range(window // 2 + 1):
        start = at[(mask >> o) & 1 == 1] - o
        np.add.at(edge, start, 1)
        np.add.at(edge, start + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _runs(gone: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
    return [{"start": a, "length": b - a} for a, b in zip(starts, ends, strict=True)]


def remove_repeated_windows(
    documents: DataFrame, window: int = WINDOW, capacity: int = CAPACITY, texts: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; with ``texts`` also the kept words and the removed spans.

    Every word goes that lies in a run of ``window`` words which starts anywhere else as well, judged
    on the whole input. Kept words are joined by one space.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    spark = prepare(documents.sparkSession)
    folder = shared_folder(spark)
    found = repeats(documents, folder, window, capacity)
    more = ", kept string, spans array<struct<start: long, length: long>>" if texts else ""

    def clean(rows: pa.Table) -> pa.Table:
        name = rows.column("slice")[0].as_py()
        ids: list[int | None] = []
        sizes: list[int] = []
        for doc_id, first, words in _read_pieces(folder, name):
            if first:
                ids.append(doc_id)
                sizes.append(0)
            sizes[-1] += len(words)
        starts = np.frombuffer(b"".join(rows.column("starts").drop_null().to_pylist()), "<i8")
        rows = rows.filter(rows.column("at").is_valid())
        at = np.concatenate([rows.column("at").to_numpy(), starts])
        mask = np.concatenate([rows.column("mask").to_numpy(), np.ones(len(starts), np.int64)])
        gone = _covered(sum(sizes), at, mask, window)
        out, at, k = [], 0, -1
        pieces = _read_pieces(folder, name)
        digest, kept, any_kept = hashlib.sha256(), [], False

        def finish() -> None:
            begin = at - sizes[k]
            row = [ids[k], sizes[k], int(gone[begin:at].sum()), digest.hexdigest()]
            out.append([*row, b" ".join(kept).decode("utf-8", "replace"), _runs(gone[begin:at])] if texts else row)

        for _, first, words in pieces:
            if first:
                if k >= 0:
                    finish()
                digest, kept, any_kept, k = hashlib.sha256(), [], False, k + 1
            own = gone[at : at + len(words)]
            at += len(words)
            words = list(itertools.compress(words, (~own).tolist())) if own.any() else words
            if words:
                digest.update((b" " if any_kept else b"") + b" ".join(words))
                any_kept = True
            if texts:
                kept += words
        if k >= 0:
            finish()
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"]
        columns = list(zip(*out, strict=True))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names[: len(columns)])

    return found.groupBy("slice").applyInArrow(clean, f"doc_id long, n_words long, n_removed long, kept_sha256 string{more}")
