"""Route and sensitive-field configuration from JSON documents.

The readers take a table of documents (one text per job), so that one job reads many
configurations; ``read_documents`` makes such a table from files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import compact_list, key_list
from rowtide.operators.routing import one_route_per_table

_ENTRY = (
    "struct<dbname:string,tablename:string,primarykey:string,sourceType:string,topic:string,"
    "sensitive:string,sensefield:string>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``job`` is its path, ``config`` its whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("job"), F.col("value").alias("config")
    )


def parsed_meta(text: Column) -> Column:
    """The table list of a configuration: under ``data``, at the top, or the bare array."""
    nested = F.from_json(text, f"data struct<db_tab_meta:array<{_ENTRY}>>")
    top = F.from_json(text, f"db_tab_meta array<{_ENTRY}>")
    bare = F.from_json(text, f"array<{_ENTRY}>")
    return F.when(F.ltrim(text).startswith("["), bare).otherwise(
        F.coalesce(nested["data"]["db_tab_meta"], top["db_tab_meta"])
    )


def load_routes(configs: DataFrame, text: str = "config") -> DataFrame:
    """Routes per job; a later entry of the same ``db.table`` wins.

    The sensitive list is optional: the last entry that has one counts. A bare array (the local
    form) is read the same way and has no sensitive list.
    """
    entries = configs.select("job", F.posexplode(parsed_meta(F.col(text))).alias("_pos", "_m"))
    listed = F.when(F.col("_m.sensitive").isNotNull(), F.struct("_pos", "_m.sensitive"))
    return (
        entries.groupBy("job", F.col("_m.dbname").alias("dbname"), F.col("_m.tablename").alias("tablename"))
        .agg(F.max(F.struct("_pos", "_m")).alias("_last"), F.max(listed).alias("_listed"))
        .select(
            "job",
            "dbname",
            "tablename",
            F.col("_last._m.topic").alias("topic"),
            F.col("_last._m.sourceType").alias("source_type"),
            key_list(F.col("_last._m.primarykey")).alias("key_columns"),
            compact_list(F.col("_listed.sensitive")).alias("sensitive"),
        )
    )


def job_routes(configs: DataFrame, jobs: DataFrame | None = None, text: str = "config") -> DataFrame:
    """One route per table from the configurations of several jobs: the last job's, sensitive lists merged.

    ``jobs`` (job, rank) selects the jobs and puts them in order; without it all count, in the
    order of their names.
    """
    routes = load_routes(configs, text)
    if jobs is None:
        names = routes.select("job").distinct().withColumn("rank", F.col("job"))
    else:
        names = jobs.select("job", "rank")
    return one_route_per_table(routes.join(names, "job"))


def load_sensitive(configs: DataFrame, text: str = "config") -> DataFrame:
    """Sensitive fields per ``db.table`` from ``info.content.db_tab_meta``; the last entry wins."""
    parsed = F.from_json(
        F.col(text), f"info struct<content:struct<db_tab_meta:array<{_ENTRY}>>>"
    )["info"]["content"]["db_tab_meta"]
    entries = configs.select("job", F.posexplode(parsed).alias("_pos", "_m")).where(
        F.col("_m.sensefield").isNotNull()
    )
    return (
        entries.groupBy("job", F.col("_m.dbname").alias("dbname"), F.col("_m.tablename").alias("tablename"))
        .agg(F.max(F.struct("_pos", "_m.sensefield")).alias("_last"))
        .select(
            "job", "dbname", "tablename", compact_list(F.col("_last.sensefield")).alias("sensitive")
        )
    )


def with_sensitive(routes: DataFrame, sensitive: DataFrame) -> DataFrame:
    """Routes, one per table, whose sensitive lists come from a separate configuration.

    Lists of the same table from several jobs are merged.
    """
    merged = sensitive.groupBy("dbname", "tablename").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("sensitive")))).alias("sensitive")
    )
    return one_route_per_table(routes).drop("sensitive").join(merged, ["dbname", "tablename"], "left")
