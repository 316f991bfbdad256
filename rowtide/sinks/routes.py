"""Versions of the routes of a running job, and from which position on each holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.routing import VersionedRoutes, one_route_per_table
from rowtide.sinks.commits import publish, published, read_committed

_RUN = "routes"
_LIST = T.ArrayType(T.StringType())
_ROUTES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("dbname", "tablename", "topic", "source_type")]
    + [T.StructField(n, _LIST) for n in ("key_columns", "sensitive")]
)
_STARTS = T.StructType(
    [
        T.StructField("src_topic", T.StringType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("from_offset", T.LongType()),
    ]
)


@dataclass(frozen=True)
class RouteLog:
    """A folder of route versions, numbered from 0; a version appears as a whole and never changes.

    One job writes it. A version that was noted by an epoch which was then not published stays: if
    the routes have changed again by the restart, the next version begins at the same positions and
    the one before holds nowhere.
    """

    out: str

    def note(self, routes: DataFrame, positions: DataFrame | None) -> int:
        """The version of these routes; a new one, from the positions on, if they are not the newest known.

        Source partitions without a position have not been read, so all of their rows lie in versions
        that are still to begin or in the newest one.
        """
        spark = routes.sparkSession
        now = one_route_per_table(routes.where(F.col("topic").isNotNull())).select(*_ROUTES.names)
        known = [version for _, version in published(self.out)]
        if known and self._same(now, self._read(spark, "routes", _ROUTES).where(F.col("version") == known[-1])):
            return known[-1]
        version = known[-1] + 1 if known else 0
        # A row without a partition, so that a version without routes is known too.
        starts = spark.createDataFrame([(None, None, None)], _STARTS)
        if positions is not None:
            topic = F.coalesce("src_topic", F.lit("")) if "src_topic" in positions.columns else F.lit("")
            begin = F.col("next_offset").alias("from_offset")
            starts = starts.unionByName(positions.select(topic.alias("src_topic"), "src_partition", begin))
        for name, rows in (("routes", now), ("starts", starts)):
            rows.write.mode("overwrite").parquet(f"{self.out}/{name}/run={_RUN}/epoch={version}")
        publish(self.out, _RUN, version, ["routes", "starts"])
        return version

    def read(self, spark: SparkSession) -> VersionedRoutes:
        """All versions, also for converting an old stretch of the log again."""
        return VersionedRoutes(self._read(spark, "routes", _ROUTES), self._read(spark, "starts", _STARTS))

    def _read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        return read_committed(spark, self.out, table, schema).select(F.col("epoch").alias("version"), *schema.names)

    @staticmethod
    def _same(left: DataFrame, right: DataFrame) -> bool:
        right = right.select(*left.columns)
        return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
