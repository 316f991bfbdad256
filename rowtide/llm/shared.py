"""What the operators share: session settings, intermediate tables, files written by tasks."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch; texts may be long, so batches are kept far below Spark's default.
BATCH_ROWS = "512"
_STAGED: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and the package on the Python path of local workers.

    On a cluster the package is shipped with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, paths)))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster the executors
    would not see it, so there its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = Path(tempfile.mkdtemp(prefix="rowtide-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stage(frame: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them again: cuts lineage, survives executors."""
    spark = frame.sparkSession
    folder = shared_folder(spark)
    frame.write.option("compression", "zstd").parquet(folder)
    _STAGED.append(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def release(kept: DataFrame) -> None:
    """Delete the tables that ``stage`` has made so far, but for those that this frame reads.

    For a pipeline whose next step needs nothing but its input, which is stored.
    """
    read = {path.rpartition("/")[0].rpartition("/")[2] for path in kept.inputFiles()}
    for folder in [f for f in _STAGED if f.rpartition("/")[2] not in read]:
        _STAGED.remove(folder)
        files, path = file_system(folder)
        if files.get_file_info(path).type == pafs.FileType.Directory:
            files.delete_dir(path)


def drop(staged: DataFrame) -> None:
    """Delete a table that ``stage`` has made and that nothing will read again."""
    folders = {path.rpartition("/")[0] for path in staged.inputFiles()}
    for folder in folders:
        files, path = file_system(folder)
        files.delete_dir(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else Path(uri).absolute().as_uri())


@contextmanager
def new_file(uri: str) -> Iterator:
    """A stream to a file that gets its name when all is written; a failed task leaves no such name."""
    files, path = file_system(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(part, compression=None) as out:
        yield out
    files.move(part, path)
