"""Every registered query gives the rows of its SQL on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracles import oracles
from checks.queries import registered
from tests.conftest import TABLES

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES)


def test_every_query_has_its_sql():
    assert set(registered()) == set(oracles())
    assert set(registered()) <= set(contract.queries())
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_rows_match(spark, duck, name):
    difference, _ = differences(spark, duck, TABLES, contract.queries()[name], SQL[name])
    assert difference == ""


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["topic", "row_num"]
    assert frame.count() == 3


def test_the_rest_loads_without_a_library_of_the_training_data_operators(monkeypatch, capsys):
    import sys

    for name in [n for n in sys.modules if n.startswith("rowtide.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    assert set(contract.queries()) == set(registered()) and set(contract.oracle_sql()) == set(oracles())
    assert "without the training-data operators" in capsys.readouterr().err
