"""Repeated byte strings within and across documents, by sharded Burrows-Wheeler search (operator 9).

Every window of ``length`` bytes has an anchor: its leftmost gram of least hash. Equal windows have
equal anchors at equal places, so a window can only be repeated where its anchor gram is. The rows
of the cluster are anchors, not bytes:

1. Tasks write the texts to slice files in the shared folder, some MB each, and give the anchors
   with the windows they stand for.
2. Anchor grams that occur once are dropped; they are counted within tasks first.
3. The tasks of the slices cut out the bytes around the anchors that are left, a context each.
   Equal contexts are one row with a count from then on.
4. All contexts of a gram meet in one text of the Burrows-Wheeler search (``bwt``), together with
   those of other grams up to a bounded size. It says which windows of a context are repeated.
5. The verdicts go back to the places of the contexts, and the tasks of the slices remove the bytes.

A gram with more than ``capacity`` different contexts is taken apart into its single windows, which
are counted by a 128-bit hash each: exact as well, and without any task that holds the gram's rows.

Nulls and ties: a null text is empty. Rows that repeat a document are documents of their own, so
their windows are repeated. Rows without a doc_id are kept. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm import bwt
from rowtide.llm.shared import drop, file_system, new_file, prepare, shared_folder, stage

LENGTH = 200
GRAM = 64
#: Bytes of a slice and of a search; different contexts of a gram beyond which windows are counted singly.
SLICE_BYTES = 4 << 20
SEARCH_BYTES = 1 << 20
CAPACITY = 6_000
_PIECE = 1 << 18

_SLICE = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of the gram at every place, from those of its halves."""
    u = np.uint32
    unit = (data.astype(u) + u(1)) * u(0x9E3779B1)
    unit ^= unit >> u(15)
    power, size = 0x85EBCA6B, 1
    have, done, left = unit, None, gram
    while True:
        if left & 1:
            n = len(have) if done is None else len(done) - size
            done = have if done is None else done[:n] * u(power) + have[len(have) - n :]
        left >>= 1
        if not left:
            break
        have = have[:-size] * u(power) + have[size:]
        power, size = power * power % (1 << 32) | 1, size * 2
    done = done ^ (done >> u(16))
    done = done * u(0xC2B2AE35)
    return done ^ (done >> u(13))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values, size = pick(values[:-size], values[size:]), size * 2
    return pick(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor place, first window and number of windows, for the texts that end at ``ends``.

    No window crosses an end. The leftmost of equal least grams is the anchor, so that it depends on
    the window's bytes alone.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    width = length - gram + 1
    hashes = _gram_hashes(data, gram)
    least = _sliding(hashes, width, np.minimum)
    n = len(least)
    begins = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(n + 1, np.int32)
    some = ends - begins >= length
    np.add.at(inside, begins[some], 1)
    np.add.at(inside, np.minimum(ends[some] - length + 1, n), -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])))
    new[begins[begins < n]] = True
    low = np.flatnonzero(new)
    high = np.append(low[1:], n) - 1
    low, high = low[inside[low]], high[inside[low]]
    padded = np.concatenate((np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)))
    chosen = np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)
    places = np.sort((hashes[chosen].astype(np.uint64) << np.uint64(32)) | chosen.astype(np.uint64))
    out = []
    while len(low):
        ask = (least[low].astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)
        place = (places[np.searchsorted(places, ask)] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        last = np.minimum(high, place)
        out.append((place, low, last - low + 1))
        more = high > last
        low, high = last[more] + 1, high[more]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def _texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


def _slice_anchors(texts: list[bytes], length: int, gram: int) -> pa.RecordBatch:
    """h, at (first window) and span of a slice's anchors; texts are taken some at a time."""
    found, base, some, held = [], 0, [], 0
    for i, text in enumerate(texts):
        some.append(text)
        held += len(text)
        if held >= _PIECE or i + 1 == len(texts):
            data, ends = _texts(some)
            place, low, span = anchors(data, ends, length, gram)
            raw = data.tobytes()
            digest = xxhash.xxh3_64_intdigest
            h = np.array([digest(raw[p : p + gram]) for p in place.tolist()], np.uint64).view(np.int64)
            found.append((h, low + base, span))
            base, some, held = base + held, [], 0
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def slices(documents: DataFrame, folder: str, length: int, gram: int) -> DataFrame:
    """Write the slice files; rows slice, h, at, span, and one with a null h for every slice.

    A slice is named by the attempt that wrote it, so a repeated task leaves files that no row names.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, names = [], [], 0, itertools.count(TaskContext.get().taskAttemptId() << 20)

        def flush() -> pa.RecordBatch:
            name = next(names)
            rows = pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], schema=_SLICE)
            with new_file(_slice_path(folder, name)) as out:
                pq.write_table(rows, out, compression="zstd", use_dictionary=False)
            h, at, span = _slice_anchors(texts, length, gram)
            n = len(h)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n + 1, name, np.int64)),
                    pa.array([None, *h.tolist()], pa.int64()),
                    pa.array([None, *at.tolist()], pa.int64()),
                    pa.array([None, *span.tolist()], pa.int32()),
                ],
                names=["slice", "h", "at", "span"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                ids.append(doc_id)
                texts.append(raw)
                held += len(raw)
                if held >= SLICE_BYTES:
                    yield flush()
                    ids, texts, held = [], [], 0
        if ids:
            yield flush()

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(cut, "slice long, h long, at long, span int")


def _slice_path(folder: str, name: int) -> str:
    return f"{folder}/slice-{name:016x}.parquet"


def _read_slice(folder: str, name: int) -> tuple[list[int | None], list[bytes]]:
    files, path = file_system(_slice_path(folder, name))
    with files.open_input_file(path) as source:
        rows = pq.read_table(source)
    return rows.column(0).to_pylist(), rows.column(1).to_pylist()


def contexts(candidates: DataFrame, folder: str, length: int) -> DataFrame:
    """slice, h, at, span, cid and the bytes of every context; bytes once per slice and context."""

    def cut(rows: pa.Table) -> pa.Table:
        raw = b"".join(_read_slice(folder, rows.column("slice")[0].as_py())[1])
        seen: set[bytes] = set()
        cids, data = [], []
        for h, at, span in zip(*(rows.column(c).to_pylist() for c in ("h", "at", "span")), strict=True):
            part = raw[at : at + span + length - 1]
            cid = xxhash.xxh3_128_digest(h.to_bytes(8, "little", signed=True) + part)
            cids.append(cid)
            data.append(None if cid in seen else part)
            seen.add(cid)
        return rows.append_column("cid", pa.array(cids, pa.binary())).append_column("data", pa.array(data, pa.binary()))

    kept = candidates.select("slice", "h", "at", "span")
    return kept.groupBy("slice").applyInArrow(cut, "slice long, h long, at long, span int, cid binary, data binary")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def search(distinct: DataFrame, length: int, search_bytes: int = SEARCH_BYTES) -> DataFrame:
    """cid, low, high: the runs of repeated windows of the contexts (h, cid, n, data)."""
    schema = pa.schema([("cid", pa.binary()), ("low", pa.int32()), ("high", pa.int32())])

    def verdicts(rows: list[tuple[int, bytes, int, bytes]]) -> pa.RecordBatch:
        text = np.frombuffer(b"".join(d + b"\xff" for *_, d in rows), np.uint8)
        repeated = bwt.repeated_starts(text, length)
        cids, lows, highs, at = [], [], [], 0
        for _, cid, n, data in rows:
            span = len(data) - length + 1
            low, high = ([0], [span]) if n > 1 else (x.tolist() for x in _runs(repeated[at : at + span]))
            cids += [cid] * len(low)
            lows += low
            highs += high
            at += len(data) + 1
        return pa.RecordBatch.from_pydict({"cid": cids, "low": lows, "high": highs}, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, group, held = [], [], 0

        def close() -> None:
            """Groups of one context need no search: it is repeated as a whole or not at all."""
            nonlocal held
            if len(group) > 1:
                whole.extend(group)
                held += sum(len(r[3]) + 1 for r in group)
            elif group and group[0][2] > 1:
                alone.append(group[0])
            group.clear()

        alone: list[tuple[int, bytes, int, bytes]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    close()
                    if held >= search_bytes:
                        yield verdicts(whole)
                        whole, held = [], 0
                    if len(alone) >= 1024:
                        yield single(alone)
                        alone = []
                group.append(row)
        close()
        if whole:
            yield verdicts(whole)
        if alone:
            yield single(alone)

    def single(rows: list[tuple[int, bytes, int, bytes]]) -> pa.RecordBatch:
        spans = [len(r[3]) - length + 1 for r in rows]
        return pa.RecordBatch.from_pydict({"cid": [r[1] for r in rows], "low": [0] * len(rows), "high": spans}, schema=schema)

    placed = distinct.select("h", "cid", "n", "data").repartition("h").sortWithinPartitions("h", "cid")
    return placed.mapInArrow(run, "cid binary, low int, high int")


def single_windows(places: DataFrame, folder: str, length: int) -> DataFrame:
    """slice, low, high: repeated windows of contexts (slice, at, span), each counted by itself."""

    def cut(rows: pa.Table) -> pa.Table:
        raw = b"".join(_read_slice(folder, rows.column("slice")[0].as_py())[1])
        wins = np.concatenate([np.arange(a, a + s) for a, s in zip(rows.column("at").to_pylist(), rows.column("span").to_pylist(), strict=True)])
        hashes = [xxhash.xxh3_128_digest(raw[w : w + length]) for w in wins.tolist()]
        name = np.full(len(wins), rows.column("slice")[0].as_py(), np.int64)
        return pa.Table.from_arrays([pa.array(name), pa.array(wins), pa.array(hashes, pa.binary())], names=["slice", "low", "w"])

    windows = stage(places.select("slice", "at", "span").groupBy("slice").applyInArrow(cut, "slice long, low long, w binary"))
    repeated = windows.groupBy("w").count().where("count > 1").select("w")
    return windows.join(repeated, "w", "left_semi").select("slice", "low", (F.col("low") + 1).alias("high"))


def removals(documents: DataFrame, folder: str, length: int, gram: int, capacity: int) -> DataFrame:
    """slice, low, high: the runs of places where repeated windows start; a null run for every slice."""
    found = stage(slices(documents, folder, length, gram))
    marks = stage(found.where("h is null").select("slice", F.col("at").alias("low"), F.col("at").alias("high")))
    grams = found.where("h is not null")
    repeated = stage(grams.groupBy("h").count().where("count > 1").select("h"))
    placed = stage(contexts(grams.join(repeated, "h", "left_semi"), folder, length))
    drop(found)
    distinct = placed.groupBy("h", "cid").agg(F.count("*").alias("n"), F.any_value("data", True).alias("data"))
    distinct = stage(distinct)
    hot = distinct.groupBy("h").count().where(F.col("count") > capacity).select("h")
    verdict = search(distinct.join(hot, "h", "left_anti"), length)
    runs = placed.select("slice", "at", "cid").join(verdict, "cid").select(
        "slice", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high")
    )
    runs = runs.unionByName(marks)
    hot = stage(hot)
    if not hot.isEmpty():
        runs = runs.unionByName(single_windows(placed.join(hot, "h", "left_semi"), folder, length))
    return runs


def _cleaned(ids: list, texts: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> Iterator[tuple]:
    """doc_id, text, removed places of the slice's documents."""
    data, ends = _texts(texts)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, low, 1)
    np.add.at(edge, high - 1 + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    begin = 0
    for doc_id, text, end in zip(ids, texts, ends.tolist(), strict=True):
        yield doc_id, text, gone[begin:end]
        begin = end


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, capacity: int = CAPACITY, texts: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``texts`` also the kept bytes.

    Every byte goes that lies in a string of ``length`` bytes which starts anywhere else as well,
    judged on the whole input.
    """
    if not 0 < gram <= length:
        raise ValueError("the gram must be within the length")
    spark = prepare(documents.sparkSession)
    folder = shared_folder(spark)
    runs = removals(documents, folder, length, gram, capacity)

    def clean(rows: pa.Table) -> pa.Table:
        ids, raw = _read_slice(folder, rows.column("slice")[0].as_py())
        pairs = rows.filter(rows.column("low").is_valid())
        low, high = (pairs.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        out = []
        for doc_id, text, gone in _cleaned(ids, raw, low, high, length):
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
            sha = hashlib.sha256(kept).hexdigest()
            out.append((doc_id, len(text), int(gone.sum()), len(_runs(gone)[0]), sha, kept)[: 6 if texts else 5])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        columns = list(zip(*out, strict=True))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], names=names[: len(columns)])

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")
    return runs.groupBy("slice").applyInArrow(clean, ddl)
