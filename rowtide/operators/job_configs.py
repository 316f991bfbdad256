"""Operators over many job configurations at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import db_table
from rowtide.sources.config import parsed_meta

# The field list the generator was run with.
SENSITIVE_FIELDS = (
    "customerName", "address", "phone", "usermob", "email",
    "remark", "userremark", "orderftel", "premark",
)


def routed_tables(configs: DataFrame, text: str = "config") -> DataFrame:
    """Distinct ``db.table`` over all job configurations."""
    return (
        configs.select(F.explode(parsed_meta(F.col(text))).alias("_m"))
        .select(db_table(F.col("_m.dbname"), F.col("_m.tablename")).alias("db_tab"))
        .distinct()
    )


def sensitive_configs(
    configs: DataFrame, fields: Sequence[str] = SENSITIVE_FIELDS, text: str = "config"
) -> DataFrame:
    """One sensitive-field document per job, listing the fields for each of its tables.

    A job's tables are one array of its own document, so this is a projection without a shuffle.
    """
    listed = F.lit(",".join(fields))
    tables = F.transform(
        F.coalesce(parsed_meta(F.col(text)), F.array()),
        lambda m: F.struct(
            m["dbname"].alias("dbname"),
            m["tablename"].alias("tablename"),
            listed.alias("sensefield"),
        ),
    )
    document = F.to_json(F.struct(F.struct(tables.alias("db_tab_meta")).alias("data")))
    return configs.select("job", document.alias("config"))
