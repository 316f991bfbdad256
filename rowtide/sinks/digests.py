"""Digests of a feed, kept run by run, so that a later comparison digests new keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowtide.operators.digests import DIGEST, added, key_digests
from rowtide.sinks.commits import is_published, publish, read_committed

_TABLE = "digests"
_SCHEMA = T.StructType([T.StructField(name, T.LongType()) for name in ("bucket", *DIGEST)])


def keep_digests(part: DataFrame, out: str, step: int, feed: str = "feed") -> None:
    """Digest a part of a feed under its step, 0, 1, 2 and so on. A step that is kept stays as it is."""
    if not is_published(out, feed, step):
        key_digests(part).write.mode("overwrite").parquet(f"{out}/{_TABLE}/run={feed}/epoch={step}")
        publish(out, feed, step, [_TABLE])


def kept_digests(spark: SparkSession, out: str, feed: str = "feed") -> DataFrame:
    """The digests of all steps of a feed that were kept, added up."""
    rows = read_committed(spark, out, _TABLE, _SCHEMA)
    return added(rows.where(rows["run"] == feed))
