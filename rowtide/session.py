"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the one SQL option that changes results.

    A row may carry the same column name twice; the last one wins, as in a hash map that is
    filled in order. Everything else is the application's to set, see ``tune_session``.
    """
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    return spark


def tune_session(spark: SparkSession) -> SparkSession:
    """Settings that concern speed only; for applications that have none of their own.

    The adaptive options are Spark's defaults, stated because the plans count on them: a lookup
    side is broadcast only after Spark has checked its size, and a hot join partition is split.
    The JVM does not compile methods over 8000 bytes, which wide row images reach, so Spark is
    told to fall back to its split projections there. A low open cost lets files far smaller than
    a split still use every core; large files are cut as before.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "262144")
    return spark
