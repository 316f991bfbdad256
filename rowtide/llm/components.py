"""Connected components of a link table, by alternating star steps on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.shared import stage

#: Rounds after which something must be wrong: each at least halves the paths that are left.
MOST_ROUNDS = 60


def _least(links: DataFrame) -> DataFrame:
    """Every u with the smallest of itself and its neighbours, summed up within tasks first."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """u, root: for every end of a link (u, v) the smallest value of its component.

    Each round is written to the shared folder. Links stay about as many as they were, also where
    one value has a third of them; joins on such a value are split by adaptive execution.
    """
    links = stage(_small_star(links.where("u != v")))
    seen = None
    for _ in range(MOST_ROUNDS):
        links = stage(_small_star(_large_star(links)))
        state = links.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        if state == seen:
            return links.select("u", F.col("v").alias("root"))
        seen = state
    raise RuntimeError("components did not settle")
