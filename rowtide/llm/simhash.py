"""SimHash near-duplicates by sharded BK-trees (operator 1).

Documents get 64-bit fingerprints of their word shingles. Fingerprints that differ in few bits
agree in some of the blocks they are cut into (pigeonhole), so every link lies inside a shard: the
fingerprints that agree in certain blocks. A shard's BK-tree is sent to the task that probes it; a
probe follows only the edges within the radius of its distance. Shards of more than ``capacity``
fingerprints are cut into pieces and every two pieces meet in a tree of their own, so no tree is
larger than that and no link is lost. Trees give the components of their shard as stars; the stars
are joined to components on the cluster.

``one_of_each`` links by the exact Jaccard similarity of shingle sets. Candidates come from two sources.
The SimHash trees give the components of the sets' fingerprints, and the texts of a component meet. As
texts of that similarity may differ in more bits than any block table can bound, texts also meet that
share one of their ``KEYS`` least shingles by hash, which they nearly always do. Where they meet, the
whole sets are made from the texts again and compared. A key of one text is dropped before any text is
moved, and of keys with the same texts one is kept. Texts with the same set are one node. A component
or shingle of many texts makes a large shard, which is cut into pieces that all meet.

Nulls and ties: a null text has no words, and a document without words has fingerprint zero, which
links like any other. Rows without a doc_id get the component of their fingerprint, null if nothing
in it has an id. Rows that repeat an id each give a row. Other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.bktree import Trees
from rowtide.llm.components import components
from rowtide.llm.shared import prepare, stage

RADIUS = 4
#: Fingerprints of a tree at most.
CAPACITY = 16_384
#: Fingerprints a shard should have on average at most, by which the number of blocks is chosen.
TYPICAL = 2_048
_SEED = 42
#: Least shingle hashes of a document that are shard keys, and bytes of text a shard and a task should hold.
KEYS, SHARD_BYTES = 10, 16 << 20


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of the words, ASCII letters in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, _SEED)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - size] + 1).tolist()]
    ends = [*gaps[size - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], _SEED) for a, b in zip(starts, ends, strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, size: int = 4) -> DataFrame:
    """doc_id and the fingerprint as a long with the same bits."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(shingle_hashes(text.as_py(), size)) for text in batch.column(1)]
            fp = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(hashed, "doc_id long, fp long")


def block_masks(n: int, radius: int) -> list[int]:
    """Masks of the shard tables: one of them covers only equal bits of any two within the radius.

    With b blocks, any two within the radius agree in b - radius of them. More blocks give more
    tables with longer keys, so that a shard has about TYPICAL of n fingerprints at most.
    """
    for blocks in range(radius + 1, 65):
        bounds = [64 * i // blocks for i in range(blocks + 1)]
        masks = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:], strict=False)]
        keep = blocks - radius
        if n >> min(64, 64 * keep // blocks) <= TYPICAL or blocks >= 2 * radius:
            return [sum(chosen) for chosen in combinations(masks, keep)]
    raise ValueError("no such radius")


def shard_entries(distinct: DataFrame, radius: int, capacity: int) -> DataFrame:
    """shard, fp: every fingerprint once in each tree that it belongs to."""
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(distinct.count(), radius)]
    entries = distinct.select(F.explode(F.array(*(F.lit(m) for m in masks))).alias("mask"), "fp").select(
        F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp"
    )
    return split_shards(entries, capacity)


def split_shards(entries: DataFrame, capacity: int) -> DataFrame:
    """The entries (key, fp and more) with key made shard: of large ones a shard per two pieces.

    The list of large ones is short and on disk, so that Spark knows its size when it picks the join.
    """
    more = [c for c in entries.columns if c not in ("key", "fp")]
    large = stage(entries.groupBy("key").count().where(F.col("count") > capacity))
    pieces = F.ceil(F.coalesce("count", F.lit(1)) * 2.5 / capacity).cast("int")
    entries = entries.join(large, "key", "left").withColumn("pieces", F.when(F.col("count").isNull(), 1).otherwise(pieces))
    entries = entries.withColumn("own", F.pmod(F.xxhash64(F.lit("piece"), "fp"), F.col("pieces")).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return entries.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fp", *more)


def star_links(entries: DataFrame, radius: int) -> DataFrame:
    """u, v: in every shard each fingerprint with one of its component there."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        fp = rows.column("fp").to_numpy()
        label = Trees(rows.column("shard").to_numpy(), fp.view(np.uint64)).components(radius)
        own = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[label[own]])], names=["u", "v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 1 << 16:
                rows = pa.Table.from_batches(held)
                shard = rows.column("shard").to_numpy()
                cut = int(np.searchsorted(shard, shard[-1]))
                if cut:
                    yield links(rows.slice(0, cut))
                    rows = rows.slice(cut)
                held = rows.combine_chunks().to_batches()
        if held:
            yield links(pa.Table.from_batches(held))

    placed = entries.repartition("shard").sortWithinPartitions("shard", "fp")
    return placed.mapInArrow(search, "u long, v long").distinct()


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each of these sorted sets one of its component, by links of that Jaccard similarity.

    Sets that a component has are not compared again, and leave the index when half of it has gone.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    label, free = np.arange(len(sets)), np.ones(len(sets), bool)
    indexed, values, owners = -1, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for seed in range(len(sets)):
        if not free[seed]:
            continue
        free[seed] = False
        queue = [seed]
        while queue and (left := int(free.sum())):
            if indexed < 0 or 2 * left < indexed:
                rest = np.flatnonzero(free)
                values, owners, indexed = np.concatenate([sets[i] for i in rest]), np.repeat(rest, sizes[rest]), left
                order = np.argsort(values, kind="stable")
                values, owners = values[order], owners[order]
            own = sets[at := queue.pop()]
            low, high = np.searchsorted(values, own), np.searchsorted(values, own, side="right")
            many = high - low
            places = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            common = np.bincount(owners[places], minlength=len(sets))
            found = np.flatnonzero(free & (common / np.maximum(1, sizes + sizes[at] - common) >= similarity))
            label[found], free[found] = seed, False
            queue += found.tolist()
    return label


def similar_links(entries: DataFrame, size: int, similarity: float) -> DataFrame:
    """u, v: in every shard of entries (shard, fp, text) each text's fp with one of its component there."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        shard, fp = rows.column("shard").to_numpy(), rows.column("fp").to_numpy()
        label = np.arange(len(fp))
        cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)], strict=True):
            if b - a > 1:
                sets = [np.unique(shingle_hashes(t.as_py(), size)) for t in rows.column("text").slice(a, b - a)]
                label[a:b] = a + alike(sets, similarity)
        own = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[label[own]])], names=["u", "v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= SHARD_BYTES:
                rows = pa.Table.from_batches(held)
                shard = rows.column("shard").to_numpy()
                last = int(np.searchsorted(shard, shard[-1]))
                if last:
                    yield links(rows.slice(0, last))
                    held = rows.slice(last).combine_chunks().to_batches()
        if held:
            yield links(pa.Table.from_batches(held))

    placed = entries.repartition("shard").sortWithinPartitions("shard", "fp")
    return placed.mapInArrow(search, "u long, v long").distinct()


def near_duplicates(documents: DataFrame, size: int = 4, radius: int = RADIUS, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    prepare(documents.sparkSession)
    hashed = stage(fingerprints(documents, size))
    distinct = stage(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = stage(star_links(shard_entries(distinct.select("fp"), radius, capacity), radius))
    roots = components(links).select(F.col("u").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keyed_rows(documents: DataFrame, size: int) -> DataFrame:
    """Own columns as _d0, _d1, ..., a row number, fp (of the shingle set), sim (its SimHash), bytes of the text, shard keys."""
    names = documents.columns
    text = names.index("text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sims, sizes, keys = [], [], [], []
            for value in batch.column(text).cast(pa.string()):
                value = value.as_py() or ""
                hashes = np.unique(shingle_hashes(value, size))
                fps.append(xxhash.xxh64_intdigest(hashes.tobytes(), _SEED))
                sims.append(majority(hashes))
                sizes.append(len(value.encode("utf-8", "surrogatepass")))
                keys.append(hashes[:KEYS].view(np.int64).tolist())
            added = [
                pa.array(np.array(fps, np.uint64).view(np.int64)),
                pa.array(np.array(sims, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*kept, "fp", "sim", "bytes", "keys"])

    kept = [f"_d{i}" for i in range(len(names))]
    own = documents.toDF(*kept)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    rows = own.mapInArrow(hashed, f"{fields}, fp long, sim long, bytes long, keys array<long>")
    return rows.withColumn("_row", F.monotonically_increasing_id())


def tree_groups(distinct: DataFrame, radius: int, capacity: int) -> DataFrame:
    """The rows (sim and more) with the component of their SimHash as ``group``."""
    sims = stage(distinct.select(F.col("sim").alias("fp")).distinct())
    roots = components(stage(star_links(shard_entries(sims, radius, capacity), radius)))
    return distinct.join(roots.withColumnRenamed("u", "sim"), "sim", "left").withColumn("group", F.coalesce("root", "sim")).drop("root")


def one_of_each(
    documents: DataFrame, size: int = 5, similarity: float = 0.8, capacity: int = CAPACITY, common: int = 4_000,
    radius: int = RADIUS,
) -> DataFrame:
    """The documents without near copies of that similarity: of each component the least doc_id stays.

    Of rows that share it the first as written stays; where no row of a component has an id, its
    first row. Own columns come back as they were. A key that more than ``common`` documents have is
    cut into pieces, and every two of them meet. The components of SimHashes within ``radius`` bits
    are keys as well.
    """
    prepare(documents.sparkSession)
    names = documents.columns
    rows = stage(keyed_rows(documents, size))
    doc_id = F.col(f"_d{names.index('doc_id')}").cast("long")
    first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("_row").alias("row"))).alias("first")
    # Rows of one set have the same keys.
    distinct = stage(rows.groupBy("fp").agg(first, F.first("keys").alias("keys"), F.first("sim").alias("sim"), F.max("bytes").alias("bytes")))
    grouped = tree_groups(distinct, radius, capacity).withColumn("key", F.xxhash64(F.lit("sim"), "group"))
    meet = ["key", "fp", F.col("first.row").alias("_row"), "bytes"]
    keyed = grouped.select(*meet).unionByName(distinct.withColumn("key", F.explode("keys")).select(*meet))
    texts = F.expr("sum(cast(xxhash64(fp) as decimal(38, 0)))").alias("texts")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum("bytes").alias("held"), texts).where("n > 1")
    shared = stage(shared.groupBy("n", "texts").agg(F.min("key").alias("key"), F.max("held").alias("held")))
    pieces = F.ceil(2.5 * F.greatest(F.col("n") / min(common, capacity), F.col("held") / SHARD_BYTES)).cast("int")
    large = (F.col("n") > min(common, capacity)) | (F.col("held") > SHARD_BYTES)
    shared = shared.select("key", F.when(large, pieces).otherwise(1).alias("pieces"))
    entries = keyed.join(shared, "key").withColumn("own", F.pmod(F.xxhash64(F.lit("piece"), "fp"), F.col("pieces")).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    entries = entries.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fp", "_row")
    text = F.col(f"_d{names.index('text')}").cast("string").alias("text")
    entries = entries.join(rows.select("_row", text), "_row").select("shard", "fp", "text")
    links = stage(similar_links(entries, size, similarity))
    roots = components(links).select(F.col("u").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").select("first", F.coalesce("root", "fp").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*(F.col(f"_d{i}").alias(name) for i, name in enumerate(names)))
