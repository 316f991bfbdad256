"""Epochs that become visible as a whole, and their compaction to few sorted files.

A job writes the tables of an epoch to ``<out>/<table>/run=<run>/epoch=<epoch>`` and then publishes the
epoch by one small file in ``<out>/_commits``, which appears as a whole. ``read_committed`` reads
published epochs only, so nobody sees half an epoch, whatever a writer left behind. An epoch that is
published stays as it is: a replay of it has nothing to do.

``compact`` merges epochs that no snapshot holds yet into a folder of sorted files, and folders of one
level into one of the next, ``FANOUT`` at a time, so each row is written once per level. A snapshot, one
small file as well, then names the folders and the last epoch of each run that they hold. Readers take
the newest snapshot and the epochs after it: before, during and after a compaction, also one that dies
half way, they read the same rows. ``vacuum`` deletes what no snapshot needs any more.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.files import file_system, names_in, read_text, write_text

#: Folders of one level that are merged into one of the next.
FANOUT = 8
#: Epoch folders that one read lists.
_TOGETHER = 2_000

_COMMIT = re.compile(r"(.*)-(\d{12})\.json")
Epoch = tuple[str, int]


def publish(out: str, run: str, epoch: int, tables: Sequence[str]) -> bool:
    """Make the epoch visible; False if it already was."""
    if is_published(out, run, epoch):
        return False
    document = {"run": run, "epoch": epoch, "tables": sorted(tables)}
    write_text(f"{out}/_commits/{run}-{epoch:012d}.json", json.dumps(document))
    return True


def is_published(out: str, run: str, epoch: int) -> bool:
    files, path = file_system(f"{out}/_commits/{run}-{epoch:012d}.json")
    return files.get_file_info(path).is_file


def published(out: str) -> list[Epoch]:
    """All published epochs, told by file names alone."""
    found = (_COMMIT.fullmatch(name) for name in names_in(f"{out}/_commits"))
    return sorted((m[1], int(m[2])) for m in found if m)


@dataclass(frozen=True)
class Snapshot:
    """Folders of merged rows by level, and the last epoch of each run that they hold."""

    version: int
    folders: tuple[tuple[int, str], ...]
    until: dict[str, int]

    def holds(self, epoch: Epoch) -> bool:
        return epoch[1] <= self.until.get(epoch[0], -1)


def snapshots(out: str, table: str) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in names_in(f"{out}/_snapshots/{table}") if name.endswith(".json"))


def snapshot(out: str, table: str) -> Snapshot:
    """The newest snapshot of a table; an empty one before the first compaction."""
    versions = snapshots(out, table)
    if not versions:
        return Snapshot(0, (), {})
    document = json.loads(read_text(f"{out}/_snapshots/{table}/{versions[-1]:012d}.json"))
    return Snapshot(versions[-1], tuple((int(level), name) for level, name in document["folders"]), document["until"])


def _with_place(schema: T.StructType) -> T.StructType:
    names = {"run", "epoch"}
    fields = [f for f in schema.fields if f.name not in names]
    return T.StructType([*fields, T.StructField("run", T.StringType()), T.StructField("epoch", T.LongType())])


def _epochs(spark: SparkSession, out: str, table: str, epochs: list[Epoch], schema: T.StructType) -> list[DataFrame]:
    """The rows of some epochs with their run and epoch, read so many folders at a time."""
    whole = _with_place(schema)
    paths = [f"{out}/{table}/run={run}/epoch={epoch}" for run, epoch in epochs]
    reader = spark.read.schema(whole).option("basePath", f"{out}/{table}")
    return [
        reader.parquet(*paths[i : i + _TOGETHER]).select(*whole.names) for i in range(0, len(paths), _TOGETHER)
    ]


def _union(spark: SparkSession, frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], _with_place(schema))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _merged(spark: SparkSession, out: str, table: str, name: str, schema: T.StructType) -> DataFrame:
    whole = _with_place(schema)
    return spark.read.schema(whole).parquet(f"{out}/{table}/_merged/{name}").select(*whole.names)


def read_committed(spark: SparkSession, out: str, table: str, schema: T.StructType) -> DataFrame:
    """The rows of all published epochs, with their run and epoch."""
    # The commits are listed before the snapshot is read: an epoch that a later snapshot holds is left out by it.
    epochs = published(out)
    now = snapshot(out, table)
    frames = [_merged(spark, out, table, name, schema) for _, name in now.folders]
    return _union(spark, frames + _epochs(spark, out, table, [e for e in epochs if not now.holds(e)], schema), schema)


def compact(
    spark: SparkSession, out: str, table: str, schema: T.StructType, sort: Sequence[str],
    partition: Sequence[str] = (), fanout: int = FANOUT,
) -> Snapshot:
    """Merge the epochs since the last snapshot, and folders of a full level; returns the newest snapshot.

    Rows are range-partitioned and sorted by ``partition`` and ``sort``, so a file holds one stretch
    of them; Spark splits what is large. One compaction of a table runs at a time.
    """
    now = snapshot(out, table)
    new = [e for e in published(out) if not now.holds(e)]
    if not new:
        return now
    folders, frames, level = list(now.folders), _epochs(spark, out, table, new, schema), 1
    while sum(1 for own, _ in folders if own == level) + 1 >= fanout:
        frames += [_merged(spark, out, table, name, schema) for own, name in folders if own == level]
        folders = [f for f in folders if f[0] != level]
        level += 1
    rows = _union(spark, frames, schema)
    order = [*partition, *sort]
    name = f"{level}-{uuid.uuid4().hex}"
    writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd")
    (writer.partitionBy(*partition) if partition else writer).parquet(f"{out}/{table}/_merged/{name}")
    until = dict(now.until)
    for run, epoch in new:
        until[run] = max(epoch, until.get(run, -1))
    made = Snapshot(now.version + 1, (*folders, (level, name)), until)
    document = {"folders": made.folders, "until": until}
    write_text(f"{out}/_snapshots/{table}/{made.version:012d}.json", json.dumps(document))
    return made


def vacuum(out: str, table: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the newest ``keep`` snapshots reads; returns what went.

    Readers that planned on an older snapshot, or on none, must have ended. Epoch folders go once the
    oldest of the kept snapshots holds them.
    """
    versions = snapshots(out, table)[-keep:]
    if len(versions) < keep:
        return []
    documents = [json.loads(read_text(f"{out}/_snapshots/{table}/{v:012d}.json")) for v in versions]
    used = {name for d in documents for _, name in d["folders"]}
    until = documents[0]["until"]
    gone = [f"_merged/{n}" for n in names_in(f"{out}/{table}/_merged") if n not in used]
    for run in names_in(f"{out}/{table}"):
        last = until.get(run.removeprefix("run="), -1)
        epochs = names_in(f"{out}/{table}/{run}") if run.startswith("run=") else []
        gone += [f"{run}/{e}" for e in epochs if int(e.removeprefix("epoch=")) <= last]
    for name in gone:
        files, path = file_system(f"{out}/{table}/{name}")
        files.delete_dir(path)
    return gone


def only_committed(rows: DataFrame, out: str) -> DataFrame:
    """Rows of a table with run and epoch columns that belong to published epochs."""
    spark = rows.sparkSession
    known = spark.createDataFrame(published(out), "run string, epoch bigint")
    return rows.withColumn("run", F.col("run").cast("string")).join(known, ["run", "epoch"], "left_semi")
