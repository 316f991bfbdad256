"""Routing of envelopes to topics by ``schema.table``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.text import compact_list, db_table, key_list

_SOURCE = ("src_topic", "src_partition")


@dataclass(frozen=True)
class VersionedRoutes:
    """Routes that change: all routes of each ``version``, and where in the log a version begins.

    ``starts`` names the first offset of a version per source partition: ``version``, ``src_topic``,
    ``src_partition``, ``from_offset``. It holds up to the next start, so every offset has one version.
    What lies before a partition's first start has the version before that one, or that one if it is
    the lowest; a partition without a start has the newest. Versions are numbered in their order. A
    version that may have neither routes nor starts is told by a row of ``starts`` without a partition.
    """

    routes: DataFrame
    starts: DataFrame


Routes = DataFrame | VersionedRoutes


def normalize_routes(raw: DataFrame) -> DataFrame:
    """Typed routes from text columns, one per table; the comma lists become arrays.

    Where a table has several, the last one in the order of ``rank`` counts, see
    ``one_route_per_table``.
    """
    def text(name: str):
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    typed = raw.select(
        "dbname",
        "tablename",
        "topic",
        text("source_type").alias("source_type"),
        key_list(text("primarykey")).alias("key_columns"),
        compact_list(text("sensitive")).alias("sensitive"),
        *[F.col(name) for name in ("rank",) if name in raw.columns],
    )
    return one_route_per_table(typed)


def one_route_per_table(routes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last route of every ``db.table`` by ``rank``, where there is one, and then by content.

    The sensitive lists of all its routes are merged. Routes that are one per table stay as they
    are, so this may be applied again. With ``by``, one per table and value of these columns.
    """
    rank = F.col("rank") if "rank" in routes.columns else F.lit(0)
    last = F.max(F.struct(rank.alias("rank"), "topic", "source_type", "key_columns"))
    hidden = F.sort_array(F.array_distinct(F.flatten(F.collect_list("sensitive"))))
    return (
        routes.groupBy(*by, "dbname", "tablename")
        .agg(last.alias("_last"), hidden.alias("sensitive"))
        .select(*by, "dbname", "tablename", "_last.topic", "_last.source_type", "_last.key_columns", "sensitive")
    )


def current_topics(routes: Routes) -> DataFrame:
    """The topics of the routes, of the newest version where they change."""
    rows = routes
    if isinstance(routes, VersionedRoutes):
        rows = routes.routes.where(F.col("version") == _versions(routes).agg(F.max("version")).scalar())
    return rows.where(F.col("topic").isNotNull()).select("topic").distinct()


def _versions(routes: VersionedRoutes) -> DataFrame:
    return routes.routes.select("version").union(routes.starts.select("version")).distinct()


def version_spans(routes: VersionedRoutes) -> DataFrame:
    """Per source partition the stretch of offsets of each version: from ``_from`` up to before ``_to``.

    A null bound is open. The stretches of a partition that has a start follow each other without a gap.
    """
    topic = F.coalesce("src_topic", F.lit("")).alias("src_topic")
    begins = routes.starts.where(F.col("src_partition").isNotNull()).groupBy(topic, "src_partition", F.col("from_offset").alias("_from")).agg(
        F.max("version").alias("_version"), F.min("version").alias("_lowest")
    )
    order = Window.partitionBy(*_SOURCE).orderBy("_from")
    spans = begins.withColumns({"_to": F.lead("_from").over(order), "_first": F.lag("_from").over(order).isNull()})
    # One row per version of the configuration, so this window is small.
    before = _versions(routes).select(
        F.col("version").alias("_lowest"), F.lag("version").over(Window.orderBy("version")).alias("_before")
    )
    earliest = spans.where("_first").join(before, "_lowest", "left").select(
        *_SOURCE, F.lit(None).cast("bigint").alias("_from"), F.col("_from").alias("_to"),
        F.coalesce("_before", "_lowest").alias("_version"),
    )
    return earliest.unionByName(spans.drop("_first", "_lowest"))


def with_version(envelopes: DataFrame, routes: VersionedRoutes) -> DataFrame:
    """Add ``_version``, the version of the routes at the envelope's place in the log.

    A row per source partition and version is looked up by the partition. Each envelope meets the versions of
    its partition, which are as many as the configuration was changed.
    """
    spans = version_spans(routes).withColumnsRenamed({"src_topic": "_topic", "src_partition": "_partition"})
    here = (
        (F.coalesce("src_topic", F.lit("")) == F.col("_topic"))
        & (F.col("src_partition") == F.col("_partition"))
        & (F.col("_from").isNull() | (F.col("src_offset") >= F.col("_from")))
        & (F.col("_to").isNull() | (F.col("src_offset") < F.col("_to")))
    )
    newest = _versions(routes).agg(F.max("version")).scalar()
    found = envelopes.join(spans, here, "left").withColumn("_version", F.coalesce("_version", newest))
    return found.drop("_topic", "_partition", "_from", "_to")


def with_route(
    envelopes: DataFrame, routes: Routes, default_topic: str | None = None
) -> DataFrame:
    """Add topic, key columns and sensitive list of ``schema.table``; null without a route.

    The match is exact, and a table has one route, see ``one_route_per_table``. There is no
    broadcast hint, so Spark broadcasts the routes only after checking their size and otherwise
    joins by key, splitting hot tables.
    With ``default_topic`` an empty route table sends every envelope to that topic. Of versioned routes
    those at the envelope's place in the log count.
    """
    by: list[str] = []
    if isinstance(routes, VersionedRoutes):
        envelopes = with_version(envelopes, routes)
        routes, by = routes.routes.withColumnRenamed("version", "_version"), ["_version"]
    lookup = one_route_per_table(routes.where(F.col("topic").isNotNull()), by).select(
        *by,
        db_table(F.col("dbname"), F.col("tablename")).alias("_db_tab"),
        "topic",
        "key_columns",
        "sensitive",
    )
    keyed = envelopes.withColumn(
        "_db_tab",
        db_table(
            F.coalesce("header.schema_name", F.lit("")), F.coalesce("header.table_name", F.lit(""))
        ),
    )
    routed = keyed.join(lookup, [*by, "_db_tab"], "left").drop("_db_tab")
    if default_topic is None:
        return routed.drop(*by)
    if by:
        some = lookup.select("_version").distinct().withColumn("_some", F.lit(True))
        unrouted = F.when(F.col("_some").isNull(), F.lit(default_topic))
        return routed.join(some, "_version", "left").withColumn("topic", F.coalesce("topic", unrouted)).drop("_version", "_some")
    configured = lookup.agg(F.count("*").alias("n")).scalar()
    return routed.withColumn(
        "topic", F.coalesce("topic", F.when(configured == 0, F.lit(default_topic)))
    )


def has_topic(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(F.col("topic").isNotNull())


def route(envelopes: DataFrame, routes: Routes, default_topic: str | None = None) -> DataFrame:
    """Keep the envelopes that have a topic, with their route."""
    return has_topic(with_route(envelopes, routes, default_topic))


def dml_only(envelopes: DataFrame) -> DataFrame:
    """Envelopes whose change is not DDL; transaction marks stay, they carry no rows."""
    return envelopes.where(~F.coalesce(F.col("row_change.is_ddl"), F.lit(False)))


def ddl_log(routed: DataFrame) -> DataFrame:
    """Routed DDL as rows of its SQL text."""
    change = "row_change." if "row_change" in routed.columns else ""
    return routed.where(F.coalesce(F.col(f"{change}is_ddl"), F.lit(False))).select(
        "src_partition",
        "src_offset",
        F.col("header.schema_name").alias("db"),
        F.col("header.table_name").alias("tab"),
        F.col(f"{change}event_type").alias("event_type"),
        F.col(f"{change}sql").alias("sql"),
        F.col("header.execute_time").alias("execute_time"),
    )
