"""Rows of nested Arrow columns against Arrow's own conversion, and how few rows the codec converts one by one."""

from __future__ import annotations

import time

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.functions.arrow_rows import to_column, to_rows
from rowtide.schemas import ENVELOPE_BODY, RECORD_BODY
from tests.builders import cell, envelope, row

FIELDS = {f.name: f.type for f in to_arrow_schema(ENVELOPE_BODY)} | {f.name: f.type for f in to_arrow_schema(RECORD_BODY)}
ENVELOPES = [
    envelope(1, rows=[row([cell("a", "x")], [cell("a", None, null=True), cell("é", "\U0001f600")]), row()]),
    envelope(2, kind="HEARTBEAT"), envelope(3, kind="TRANSACTIONBEGIN", tx_begin=dict(execute_time=None, transaction_id="t", props={"k": None})),
    envelope(4, rows=[row([dict(name=None)], ())], unset=True), {},
]
ENVELOPES[3]["row_change"]["row_datas"] += [None, dict(before=None, after=[None])]


@pytest.mark.parametrize("name", ENVELOPE_BODY.names)
def test_columns_are_those_of_arrow(name):
    rows = [e.get(name) for e in ENVELOPES] * 3
    want = pa.array(rows, FIELDS[name])
    got = to_column(rows, FIELDS[name])
    assert got.equals(want) and got.type == want.type
    for part in (want, want.slice(2, 9), want.slice(0, 0)):
        assert to_rows(part) == part.to_pylist()


def test_maps_are_dicts_or_pairs():
    rows = [{"a": None, "b": ""}, None, [("c", "d")], {}]
    assert to_column(rows, FIELDS["cur"]).to_pylist() == [[("a", None), ("b", "")], None, [("c", "d")], []]


def test_leaves_are_converted_together():
    """A row of a hundred cells costs less than half of what Arrow's conversion of each cell does."""
    kind = to_arrow_schema(ENVELOPE_BODY).field("row_change").type.field("row_datas").type
    rows = [[row([cell("name", "value")] * 100)]] * 60
    column = pa.array(rows, kind)
    times = {}
    for name, work in (("leaf", lambda: (to_rows(column), to_column(rows, kind))), ("cell", lambda: (column.to_pylist(), pa.array(rows, kind)))):
        start = time.process_time()
        work()
        times[name] = time.process_time() - start
    assert times["leaf"] < times["cell"] / 2
