"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The change log is derived and stored as Parquet once, outside the timing; the queries read it from
there. Every query is written in full to Spark's no-op sink: once to warm up, then $BENCH_RUNS
times (3 by default); the median counts. Rows and details go to standard error.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from checks import queries as Q  # noqa: E402
from rowtide.operators.ordering import number_envelopes  # noqa: E402
from rowtide.plans.convert import routed_envelopes  # noqa: E402
from rowtide.sources.tables import read_envelopes  # noqa: E402


def numbering(spark: SparkSession, sf_dir: str, widths: tuple[int, ...]) -> DataFrame:
    options = Q.HELD.but(widths=widths)
    routed = routed_envelopes(Q._log(spark, sf_dir), Q._routes(spark), options)
    return number_envelopes(routed, widths=widths).select(
        "src_partition", "src_offset", "out_batch_id", "out_in_id", "first_mid"
    )


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log, stored and read again. A local benchmark: its folder is of this machine."""
    folder = f"{tempfile.mkdtemp(prefix='bench-')}/envelopes"
    Q._log(spark, sf_dir).write.parquet(folder)
    return read_envelopes(spark, folder)


HEADLINE = {
    "rows_per_topic": Q._QUERIES["a1_rows_per_topic"],
    "full_conversion": lambda spark, sf: Q._records(spark, sf),
    "numbering_two_phase": lambda spark, sf: numbering(spark, sf, (65_536,)),
    "numbering_window": lambda spark, sf: numbering(spark, sf, ()),
    "drop_repeats": Q._QUERIES["f1_drop_repeats"],
    "missing_changes": Q._QUERIES["r3_missing_changes"],
    "send_stats": Q._QUERIES["a6_send_stats"],
    "offset_lag": Q._QUERIES["a8_offset_lag"],
    "null_audit": Q._QUERIES["r8_null_audit"],
    "watched_cells": Q._QUERIES["r6_watched_cells"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    log = stored_log(spark, sf_dir)
    Q._log = lambda spark, sf_dir: log
    seconds = {}
    for name, query in HEADLINE.items():
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
