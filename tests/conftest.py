from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH", ""))))

from rowtide import prepare_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_session(session)
    session.stop()


# Compiling code costs far more than running it on a handful of rows. The registered queries and
# the plan tests keep code generation; the tests on hand-made rows are interpreted.
COMPILED = {"test_registered_queries", "test_plans"}


@pytest.fixture(autouse=True)
def code_generation(request, spark):
    compiled = request.module.__name__.split(".")[-1] in COMPILED
    spark.conf.set("spark.sql.codegen.wholeStage", str(compiled).lower())
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK" if compiled else "NO_CODEGEN")
