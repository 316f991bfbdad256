"""Envelope batches against the same envelopes converted one by one."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.functions.arrow_rows import to_column, to_rows
from rowtide.schemas import ENVELOPE_BODY, EVENT_TYPES
from rowtide.sources import envelope_columns, wire
from rowtide.sources.messages import message_class
from tests.builders import cell, envelope, row

TYPES = {f.name: f.type for f in to_arrow_schema(ENVELOPE_BODY)}
NUMBERS = (None, 0, 1, -5, 127, 128, 16384, 2**31 - 1, -(2**31))
LONGS = (*NUMBERS, 2**49, 2**56 - 1, 2**56, 2**63 - 1, -(2**63))
TEXTS = (None, "", "a", "é\u0001", "\U0001f600", "x" * 127, "x" * 128, "x" * 20_000)
PROPS = (None, {}, {"k": "v"}, {"a": None, "b": "", "é": "x"})


def some_envelopes(seed: int, n: int) -> list[dict]:
    pick = random.Random(seed)

    def cells(most):
        return [
            dict(
                idx=pick.choice(NUMBERS), sql_type=pick.choice(NUMBERS), name=pick.choice(TEXTS[:-1]), is_key=pick.choice((None, True, False)),
                updated=pick.choice((None, True, False)), is_null=True, value=pick.choice(TEXTS), length=pick.choice(NUMBERS), mysql_type="é",
            )
            for _ in range(pick.randrange(most))
        ] or pick.choice((None, []))

    kinds = dict(ROWDATA=6, TRANSACTIONBEGIN=1, TRANSACTIONEND=1, HEARTBEAT=1)
    made = []
    for kind in pick.choices(list(kinds), kinds.values(), k=n):
        tx = dict(execute_time=pick.choice(LONGS), transaction_id=pick.choice(TEXTS), thread_id=pick.choice(LONGS), props=pick.choice(PROPS))
        one = envelope(
            pick.randrange(99), event=pick.choice(EVENT_TYPES), kind=kind, unset=pick.random() < 0.3, tx_begin=pick.choice((None, tx)), tx_end=tx,
            rows=[dict(before=cells(20), after=cells(4)) for _ in range(pick.choice((0, 1, 3, 30)))], time=pick.choice(LONGS),
        )
        one["header"] = pick.choice((None, one["header"], one["header"] | dict(props=pick.choice(PROPS), event_type=None), dict.fromkeys(one["header"])))
        one["ip"], one["entry_type"] = pick.choice(TEXTS), None if kind == "ROWDATA" and pick.random() < 0.3 else kind
        if pick.random() < 0.1:
            one["row_change"] = None
        made.append(one)
    return made


def columns_of(items) -> dict[str, pa.Array]:
    return {name: pa.array([item[name] for item in items], kind) for name, kind in TYPES.items()}


def written_by_row(items) -> list[bytes]:
    rows = zip(*[to_rows(column) for column in columns_of(items).values()])
    return [wire._envelope_bytes(dict(zip(TYPES, row))) for row in rows]


def assert_read(messages) -> list[bool]:
    """All that is told to be read has the columns of the row; which messages are left."""
    columns, odd = envelope_columns.decode(pa.array(messages, pa.binary()))
    rows = []
    for data, left in zip(messages, odd, strict=True):
        try:
            rows.append({} if left else wire._envelope_of(data or b""))
        except Exception as error:
            raise AssertionError(f"{data} does not decode") from error
    for column, (name, kind) in zip(columns, TYPES.items(), strict=True):
        column.validate(full=True)
        want = to_column([r.get(name) for r in rows], kind)
        assert column.type == kind and column.filter(pa.array(~odd)).equals(want.filter(pa.array(~odd))), name
    return odd.tolist()


@pytest.mark.parametrize("n", [1, 15, 16, 150])
def test_batches_are_the_messages_of_rows(n):
    items = some_envelopes(n, n)
    want = written_by_row(items)
    assert envelope_columns.encode(columns_of(items)).to_pylist() == want
    part = {name: column.slice(n // 2) for name, column in columns_of(items).items()}
    assert envelope_columns.encode(part).to_pylist() == want[n // 2 :]
    assert not any(assert_read(want))
    assert not any(assert_read([None, b"", *want]))


def test_damaged_messages_are_left():
    pick, messages = random.Random(5), written_by_row(some_envelopes(5, 300))
    for at, data in enumerate(messages):
        cut, byte = pick.randrange(len(data) + 1), bytes([pick.randrange(256)])
        messages[at] = pick.choice((data, data[:cut], data[:cut] + byte + data[cut + 1 :], data[:cut] + byte + data[cut:], data + byte))
    assert 0 < sum(assert_read(messages)) < 300


def test_other_orders_and_unknown_fields_are_read_by_row(spark):
    """In one batch with messages that are laid out as usual."""
    plain = written_by_row([envelope(7, rows=[row([cell("a", "1")], [cell("a", "2")])])])[0]
    ip_first = message_class("Entry")(ip="first").SerializeToString() + plain
    twice = message_class("Pair")(key="k", value="1").SerializeToString(), message_class("Pair")(key="k", value="2").SerializeToString()
    props = message_class("RowChange")(tableId=4).SerializeToString() + b"".join(b"\x6a" + bytes([len(p)]) + p for p in twice)
    values = [plain, ip_first, plain + b"\x78\x05", message_class("Entry")(storeValue=props).SerializeToString(), b"\x0a\xff", None, plain]
    assert assert_read(values) == [False, True, True, True, True, False, False]
    frame = spark.createDataFrame(list(enumerate(values)), "n int, value binary").coalesce(1)
    got = wire.decode_envelopes(frame).orderBy("n").collect()
    assert [r.decode_error is None for r in got] == [True, True, True, True, False, True, True]
    assert [r.row_change and r.row_change.table_id for r in got] == [1, 1, 1, 4, None, 0, 1]
    assert got[0][1:] == got[1][1:] == got[2][1:] == got[6][1:] and got[3].row_change.props == {"k": "2"}


@pytest.mark.parametrize("wrong", [dict(entry_type="NONE"), dict(row_change=envelope(1, rows=[row([None])])["row_change"])])
def test_rows_that_fail_still_fail(spark, wrong):
    items = [envelope(1), envelope(2) | wrong]
    with pytest.raises(pa.ArrowException):
        envelope_columns.encode(columns_of(items))
    frame = spark.createDataFrame([tuple(i[n] for n in ENVELOPE_BODY.names) for i in items], ENVELOPE_BODY).coalesce(1)
    with pytest.raises(Exception, match="KeyError|TypeError"):
        wire.encode_envelopes(frame).collect()


def test_parts_are_all_of_a_batch(spark, monkeypatch):
    monkeypatch.setattr(wire, "_PART_BYTES", 1)
    batch = pa.RecordBatch.from_pydict({"a": [1, 2, 3]})
    assert [part.column("a").to_pylist() for part in wire._parts(batch)] == [[1], [2], [3]]
    assert list(wire._parts(batch.slice(0, 0))) == []


def test_cells_are_converted_together():
    """Envelopes of a hundred cells cost less than a quarter of what they cost row by row."""
    items = [envelope(i, rows=[row([cell("name", "value")] * 50, [cell("name", None, null=True)] * 50)]) for i in range(100)]
    columns, times = columns_of(items), {}

    def by_row():
        data = written_by_row(items)
        rows = [wire._envelope_of(d) for d in data]
        return [to_column([r.get(name) for r in rows], kind) for name, kind in TYPES.items()]

    for name, work in (("batch", lambda: envelope_columns.decode(envelope_columns.encode(columns))), ("row", by_row)):
        work()
        start = time.process_time()
        work()
        times[name] = time.process_time() - start
    assert times["batch"] < times["row"] / 4, times
