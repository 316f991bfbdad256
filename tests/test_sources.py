"""Decoders, positions, configurations and source options."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rowtide.functions.record_codec import decode_record
from rowtide.schemas import RECORD_BODY
from rowtide.functions.text import map_dump, numeric_suffix_partition
from rowtide.operators.job_configs import routed_tables, sensitive_configs
from rowtide.sources import config, json_changes, kafka, positions, tables, wire
from rowtide.sources.messages import message_class
from tests.builders import cell, envelope, envelopes, row


def messages(spark, *values):
    return spark.createDataFrame(
        [("changes", 0, i, v) for i, v in enumerate(values)],
        "src_topic string, src_partition int, src_offset long, value binary",
    )


def test_envelopes_survive_the_wire(spark):
    log = envelopes(
        spark,
        envelope(1, event="UPDATE", rows=[row([cell("a", "é\u0001")], [cell("a", null=True, updated=True)])]),
        envelope(2, kind="TRANSACTIONBEGIN", tx_begin=dict(execute_time=1, transaction_id="", thread_id=3, props={})),
        envelope(3, kind="TRANSACTIONEND", tx_end=dict(execute_time=1, transaction_id="x", props={})),
        envelope(4, kind="HEARTBEAT"),
    )
    back = wire.decoded_ok(wire.decode_envelopes(wire.encode_envelopes(log))).select(log.columns)
    assert sorted(back.collect()) == sorted(log.collect())


def test_unset_fields_read_as_defaults(spark):
    got = wire.decode_envelopes(messages(spark, b"")).first()
    assert (got.entry_type, got.batch_id, got.in_id, got.ip) == ("ROWDATA", 0, 0, "")
    assert (got.header.event_type, got.header.source_type, got.header.version) == ("UPDATE", "MYSQL", 1)
    assert (got.row_change.event_type, got.row_change.is_ddl, got.row_change.row_datas) == ("UPDATE", False, [])


def test_null_cell_reads_as_empty_text(spark):
    change = message_class("RowChange")()
    change.rowDatas.add().afterColumns.add(name="a", isNull=True)
    entry = message_class("Entry")(storeValue=change.SerializeToString())
    got = wire.decode_envelopes(messages(spark, entry.SerializeToString())).first()
    column = got.row_change.row_datas[0].after[0]
    assert (column.is_null, column.value, column.is_key) == (True, "", False)


def test_bad_bytes_go_to_quarantine(spark):
    bad_row = message_class("Entry")(storeValue=b"\xff\xff").SerializeToString()
    decoded = wire.decode_envelopes(messages(spark, b"\x0a\xff", bad_row, b""))
    assert [r.src_offset for r in wire.undecodable(decoded).orderBy("src_offset").collect()] == [0, 1]
    assert wire.decoded_ok(decoded).count() == 1
    with pytest.raises(Exception, match="DecodeError"):
        wire.decode_envelopes(messages(spark, b"\x0a\xff"), strict=True).collect()


RECORD = dict(
    mid=-5, db="d", sch="d", tab="t", opt="INSERT", ts=1 << 40, ddl=None, err="",
    src={}, cur={"one": None, "two": "2", "é": ""}, cus=None,
)


def encode_record(spark, record):
    frame = spark.createDataFrame([tuple(record[n] for n in RECORD_BODY.names)], RECORD_BODY)
    return bytes(wire.encode_records(frame).first().value)


def test_record_bytes(spark):
    data = encode_record(spark, RECORD)
    assert data.startswith(bytes([9, 2]) + b"d" + bytes([2]) + b"d" + bytes([2]) + b"t" + bytes([12]) + b"INSERT")
    assert decode_record(data) == RECORD
    with pytest.raises((ValueError, IndexError)):
        decode_record(data[:-4])


@pytest.mark.parametrize("mid", [0, -1, 63, 64, -64, -65, 8191, 8192, (1 << 62) + 5, (1 << 63) - 1, -(1 << 63)])
def test_long_bytes(spark, mid):
    assert decode_record(encode_record(spark, RECORD | {"mid": mid}))["mid"] == mid


def test_long_texts(spark):
    record = RECORD | {"db": "x" * 70, "tab": "é" * 9000, "cur": {str(i): "v" * i for i in range(150)}}
    assert decode_record(encode_record(spark, record)) == record


def test_blocks_with_sizes_are_read(spark):
    plain = encode_record(spark, RECORD | {"cur": None, "src": None, "cus": {"a": "b"}})
    head, entry = plain[:-7], bytes([2]) + b"a" + bytes([0, 2]) + b"b"
    assert plain.endswith(bytes([2]) + entry + bytes([0]))
    assert decode_record(plain[:-7] + bytes([1, len(entry) * 2]) + entry + bytes([0]))["cus"] == {"a": "b"}
    assert head


def test_bad_record_bytes(spark):
    got = wire.decode_records(messages(spark, b"\x02", encode_record(spark, RECORD)))
    assert wire.undecodable(got).count() == 1
    kept = wire.decoded_ok(got).first()
    assert kept.cur == RECORD["cur"] and kept.src == {} and kept.cus is None


def test_json_changes_as_object_or_text(spark):
    change = {"schema": "s", "table": "t", "operation": "INSERT", "fields": {"a": "1", "b": None}}
    texts = [json.dumps({"data": change}), json.dumps({"data": json.dumps(change)}), "no json"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = json_changes.decode_json_changes(frame).collect()
    for got in rows[:2]:
        assert (got.schema, got.table, got.operation) == ("s", "t", "INSERT")
        assert got.fields == {"a": "1", "b": None}
    assert rows[2].schema is None and rows[2].fields is None


def entry(table, **more):
    return {"dbname": "d", "tablename": table, "primarykey": "uid", "sourceType": "02", "topic": "x"} | more


def test_routes_from_documents(spark):
    listed = [entry("a", sensitive="p,,q"), entry("b"), entry("a", topic="late", primarykey="k,")]
    frames = {}
    for name, doc in (("data", {"data": {"db_tab_meta": listed}}), ("top", {"db_tab_meta": listed}), ("bare", listed)):
        frames[name] = spark.createDataFrame([("j", json.dumps(doc))], "job string, config string")
        got = {r.tablename: r for r in config.load_routes(frames[name]).collect()}
        assert (got["a"].topic, got["a"].key_columns, got["a"].sensitive) == ("late", ["k"], ["p", "q"])
        assert (got["b"].topic, got["b"].key_columns, got["b"].sensitive) == ("x", ["uid"], None)
    assert sorted(r.db_tab for r in routed_tables(frames["data"]).collect()) == ["d.a", "d.b"]
    made = json.loads(sensitive_configs(frames["data"], ["f", "g"]).first().config)
    assert [m["tablename"] for m in made["data"]["db_tab_meta"]] == ["a", "b", "a"]
    assert made["data"]["db_tab_meta"][0]["sensefield"] == "f,g"


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([entry("a"), entry("b")], indent=1))
    got = config.load_routes(config.read_documents(spark, str(tmp_path)))
    assert sorted(r.tablename for r in got.collect()) == ["a", "b"]


def test_sensitive_documents(spark):
    doc = {"info": {"content": {"db_tab_meta": [
        {"dbname": "d", "tablename": "t", "sensefield": "a,,b,"}, {"dbname": "d", "tablename": "u"}]}}}
    frame = spark.createDataFrame([("j", json.dumps(doc))], "job string, config string")
    got, = config.load_sensitive(frame).collect()
    assert (got.tablename, got.sensitive) == ("t", ["a", "b"])


def test_positions(spark):
    frame = spark.createDataFrame([("c:1:2:3:4:5",), ("",), (None,), ("c:1:2",)], "position string")
    strict = positions.parse_positions(frame).collect()
    assert [r.status for r in strict] == ["ok", "error", "error", "error"]
    lenient = positions.parse_positions(frame, form="lenient").collect()
    assert [r.status for r in lenient] == ["ok", "latest", "latest", "error"]
    assert (lenient[0].next_offset, lenient[0].mid, lenient[1].mid) == (2, 5, 0)
    assert [r.mid for r in positions.start_mid(positions.parse_positions(frame), 9).collect()] == [5, 9, 9, 9]
    with pytest.raises(Exception, match="bad position"):
        positions.require_positions(positions.parse_positions(frame)).collect()


def test_scan_stops_at_the_first_empty_value(spark):
    stored = spark.range(50).selectExpr(
        "id as event_row", "cast(if(id = 23, null, if(id = 20, '', 'x')) as binary) as event_bytes"
    )
    assert tables.scan_stored(stored, 10, 20).count() == 13
    assert tables.scan_stored(stored, 24, 20).count() == 20
    # 0-19, 20-22 up to the empty row, 24-43, 44-49.
    assert [tuple(r) for r in tables.successive_scans(stored, 20).groupBy("scan_no").count().orderBy("scan_no").collect()] == [
        (0, 20), (1, 3), (2, 20), (3, 6)
    ]


def test_kafka_options(spark):
    rows = spark.createDataFrame(
        [("t", 1, 7), ("t", 0, 5)], "src_topic string, src_partition int, next_offset long"
    )
    assert json.loads(kafka.starting_offsets(rows)) == {"t": {"0": 5, "1": 7}}
    options = kafka.source_options("h:1", "t", kafka.explicit_offset("t", 0, 4), 100)
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "100"
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 4}}


def test_numeric_suffix(spark):
    keys = spark.createDataFrame([("a.b.17",), ("plain",), (".9",), ("x.-7",)], "key string")
    got = keys.select(numeric_suffix_partition(F.col("key"), 5).alias("p")).collect()
    assert [r.p for r in got] == [2, 0, 0, -2]


def test_map_dump(spark):
    frame = spark.createDataFrame([({"b": None, "a": "1"},), ({},), (None,)], "m map<string,string>")
    assert [r[0] for r in frame.select(map_dump(F.col("m"))).collect()] == ["[a,1][b,null]", "", ""]


def test_successive_scans_keep_every_event(spark):
    from rowtide.sources.tables import successive_scans

    empty = {0, 7, 8, 30, 59}
    rows = [(i, None if i in empty else b"" if i % 9 == 1 else b"x") for i in range(60)]
    frame = spark.createDataFrame(rows, "event_row long, event_bytes binary")
    want, scan, begun = {}, 0, 0
    for i in range(60):
        if i in empty:
            scan += -(-(i - begun) // 5)
            begun = i + 1
        else:
            want[i] = scan + (i - begun) // 5
    for widths in ((), (4,), (4, 3)):
        got = successive_scans(frame, 5, widths=widths).collect()
        assert {r.event_row: r.scan_no for r in got} == want


def test_positions_of_many_partitions_are_looked_up(spark, monkeypatch):
    from rowtide.sources import tables

    rows = [(t, p, o) for t in ("a", "b") for p in range(3) for o in range(4)]
    log = spark.createDataFrame(rows, "src_topic string, src_partition int, src_offset long")
    starts = spark.createDataFrame([("a", 0, 2), ("b", 1, 3)], "src_topic string, src_partition int, next_offset long")
    want = sorted(r for r in rows if r[2] >= {("a", 0): 2, ("b", 1): 3}.get(r[:2], 0))
    for most in (256, 1):
        monkeypatch.setattr(tables, "LITERAL_POSITIONS", most)
        assert sorted(map(tuple, tables.from_positions(log, starts).collect())) == want


def test_one_route_per_table_from_many_jobs(spark):
    import json

    from rowtide.sources.config import job_routes

    entry = lambda topic, hidden: {"dbname": "d", "tablename": "t", "topic": topic, "primarykey": "id", "sensitive": hidden}
    configs = spark.createDataFrame(
        [("j1", json.dumps([entry("x", "a"), entry("y", "b")])), ("j2", json.dumps([entry("z", "c")]))], "job string, config string"
    )
    row = job_routes(configs).collect()
    assert [(r.topic, r.sensitive) for r in row] == [("z", ["b", "c"])]
    order = spark.createDataFrame([("j1", 2), ("j2", 1)], "job string, rank int")
    assert job_routes(configs, order).first().topic == "y"
    only = spark.createDataFrame([("j1", 0)], "job string, rank int")
    assert job_routes(configs, only).first().sensitive == ["b"]
