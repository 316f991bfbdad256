"""Images, keys and projection on hand-made envelopes: every branch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowtide import VARIANTS, ConvertOptions, convert
from rowtide.operators import audit, envelopes as V, reconcile
from rowtide.operators.records import quarantined, with_key
from rowtide.operators.routing import ddl_log, route
from rowtide.plans.convert import routed_envelopes, rows_with_images
from tests.builders import cell, envelope, envelopes, routes, row

HELD = ConvertOptions(on_missing_key="quarantine", widths=())
ID = cell("id", "7", key=True)


def one(spark, item, *route_items, options=HELD, ts=99):
    table = routes(spark, *(route_items or (("t", "topic", "id", None),)))
    return convert(envelopes(spark, item), table, ts, options).collect()


def test_insert(spark):
    r, = one(spark, envelope(1, rows=[row(after=[ID, cell("v", "a"), cell("n", null=True)])]))
    assert (r.src, r.cur) == ({}, {"id": "7", "v": "a", "n": None})
    assert (r.topic, r.key, r.mid, r.db, r.sch, r.tab, r.opt) == ("topic", "7", 0, "s", "s", "t", "INSERT")
    assert (r.ts, r.ddl, r.err, r.cus) == (99, "", "", {"dmlts": "1000", "ip": "10.0.0.9"})


def test_delete(spark):
    r, = one(spark, envelope(1, event="DELETE", rows=[row(before=[ID, cell("v", "a")])]))
    assert (r.src, r.cur, r.key) == ({"id": "7", "v": "a"}, {"id": "7"}, "7")


def update_rows():
    return [row([ID, cell("v", "a"), cell("w", "b"), cell("k", "c")],
                [ID, cell("v", "z", updated=True), cell("w", "b"), cell("k", "c")])]


def test_update_shows_changed_and_key_columns(spark):
    r, = one(spark, envelope(1, event="UPDATE", rows=update_rows()), ("t", "topic", "k", None))
    assert r.cur == {"id": "7", "v": "z", "k": "c"}
    assert (r.src, r.key) == ({"id": "7", "v": "a", "w": "b", "k": "c"}, "c")


def test_update_in_full(spark):
    r, = one(spark, envelope(1, event="UPDATE", rows=update_rows()),
             options=HELD.but(update_image="full"))
    assert r.cur == {"id": "7", "v": "z", "w": "b", "k": "c"}


def test_update_without_image(spark):
    r, = one(spark, envelope(1, event="UPDATE", rows=update_rows()),
             options=HELD.but(update_image="none"))
    assert r.cur is None


def test_other_event_has_empty_maps_and_no_key(spark):
    r, = one(spark, envelope(1, event="QUERY", rows=update_rows()))
    assert (r.src, r.cur, r.key, r.opt) == ({}, {}, None, "QUERY")


def test_null_as_empty(spark):
    r, = one(spark, envelope(1, rows=[row(after=[ID, cell("n", null=True)])]),
             options=HELD.but(null_mode="empty"))
    assert r.cur == {"id": "7", "n": ""}


def test_last_of_equal_names_counts(spark):
    r, = one(spark, envelope(1, event="UPDATE", rows=[
        row([ID, cell("v", "1"), cell("v", "2")],
            [ID, cell("v", "3", updated=True), cell("v", "4")])]))
    assert (r.src["v"], r.cur["v"]) == ("2", "3")


def test_key_follows_row_order_and_null_is_empty(spark):
    cells = [cell("a", "1"), cell("b", null=True), cell("c", "3")]
    r, = one(spark, envelope(1, rows=[row(after=cells)]), ("t", "topic", "c,b,a", None))
    assert r.key == "1\u0001\u00013"
    r, = one(spark, envelope(1, rows=[row(after=cells)]), ("t", "topic", "b,a", None))
    assert r.key == "1\u0001"
    r, = one(spark, envelope(1, rows=[row(after=cells)]), ("t", "topic", "b", None))
    assert r.key == ""


def test_key_list_keeps_spaces_and_drops_trailing_commas(spark):
    cells = [cell("a", "1"), cell("b", "2")]
    r, = one(spark, envelope(1, rows=[row(after=cells)]), ("t", "topic", "a, b,,", None))
    assert r.key == "1"


def test_sensitive_columns_leave_images_and_key(spark):
    cells = [ID, cell("phone", "5"), cell("Phone", "6")]
    for event, rows in (("INSERT", row(after=cells)), ("DELETE", row(before=cells)),
                        ("UPDATE", row(cells, cells))):
        r, = one(spark, envelope(1, event=event, rows=[rows]), ("t", "topic", "phone,id", ",phone,,"))
        assert "phone" not in r.src and "phone" not in r.cur
        assert r.key == "7"
    r, = one(spark, envelope(1, rows=[row(after=cells)]), ("t", "topic", "phone,id", "phone"),
             options=VARIANTS["full_image"].but(on_missing_key="quarantine"))
    assert r.cur["phone"] == "5" and r.key == "7\u00015"


def test_missing_key(spark):
    item = envelope(1, rows=[row(after=[cell("v", "1")])])
    for keys in ("id", None, ","):
        table = ("t", "topic", keys, None)
        assert one(spark, item, table)[0].key is None
        assert one(spark, item, table, options=HELD.but(on_missing_key="batch_time"))[0].key == "99"
        with pytest.raises(Exception, match="no key column found for s.t"):
            one(spark, item, table, options=ConvertOptions())


def test_a_dropped_repeat_does_not_fail_the_job(spark):
    log = envelopes(spark, envelope(1, (5, 0), rows=[row(after=[ID])]),
                    envelope(2, (4, 0), rows=[row(after=[cell("v", "1")])]))
    table = routes(spark, ("t", "topic", "id", None))
    assert convert(log, table, 1, ConvertOptions()).count() == 1


def test_quarantine_splits_the_records(spark):
    log = envelopes(spark, envelope(1, rows=[row(after=[ID]), row(after=[cell("v")])]))
    records = convert(log, routes(spark, ("t", "topic", "id", None)), 1, HELD)
    assert [r.mid for r in with_key(records).collect()] == [0]
    assert [r.mid for r in quarantined(records).collect()] == [1]


def test_ddl_gives_no_records_but_a_log_line(spark):
    item = envelope(1, event="ALTER", ddl=True, sql="alter table t", rows=[row(after=[ID])])
    assert one(spark, item) == []
    line, = ddl_log(route(envelopes(spark, item), routes(spark, ("t", "x", "id", None)))).collect()
    assert (line.db, line.tab, line.event_type, line.sql) == ("s", "t", "ALTER", "alter table t")


def test_unknown_and_unset_types(spark):
    r, = one(spark, envelope(1, event="XYZ", rows=[row(after=[ID])]))
    assert r.opt == "UNKNOWN"


def test_variants_skip_the_repeat_filter(spark):
    log = envelopes(spark, *[envelope(i, (1, 0), rows=[row(after=[ID])]) for i in range(3)])
    table = routes(spark, ("t", "topic", "id", None))
    assert convert(log, table, 1, VARIANTS["local"]).count() == 1
    assert convert(log, table, 1, VARIANTS["local_unfiltered"]).count() == 3


def test_default_topic_only_without_routes(spark):
    log = envelopes(spark, envelope(1, rows=[row(after=[ID])]), envelope(2, table="", schema="", kind="TRANSACTIONEND"))
    options = VARIANTS["local"].but(default_topic="all")
    empty = routes(spark, ("t", "x", "id", None)).limit(0)
    assert routed_envelopes(log, empty, options).where("topic = 'all'").count() == 2
    r, = convert(log, empty, 77, options).collect()
    assert (r.topic, r.key) == ("all", "77")
    other = routes(spark, ("other", "x", "id", None))
    assert routed_envelopes(log, other, options).count() == 0


def test_row_path_and_array_path_agree(spark):
    log = envelopes(spark, *[
        envelope(i, event=e, rows=update_rows()) for i, e in enumerate(("INSERT", "UPDATE", "DELETE", "QUERY"))
    ])
    table = routes(spark, ("t", "topic", "k,id", "w"))
    rows = rows_with_images(routed_envelopes(log, table, HELD), HELD)
    records = convert(log, table, 1, HELD)
    columns = ["src_offset", "row_no", "key", "src", "cur"]
    key = lambda r: (r.src_offset, r.row_no)
    assert sorted(rows.select(*columns).collect(), key=key) == sorted(
        records.select(*columns).collect(), key=key
    )


def test_envelope_grain(spark):
    rows = [row(after=[ID]), row(after=[cell("v", "2"), cell("n", null=True)])]
    log = envelopes(
        spark, envelope(1, rows=rows), envelope(2, event="UPDATE", rows=update_rows()),
        envelope(3, event="INSERT"), envelope(4, event="ALTER", ddl=True, sql="x", rows=update_rows()),
    )
    r = {x.src_offset: x for x in V.envelope_records(log, F.lit(5)).collect()}
    assert (r[1].src, r[1].cur, r[1].mid, r[1].cus) == ({}, {"v": "2", "n": ""}, 0, None)
    assert (r[2].src, r[2].cur) == (None, None)
    assert (r[3].src, r[3].cur) == (None, None)
    assert (r[4].src, r[4].cur, r[4].ddl) == ({}, {}, "x")


def test_last_row_per_key(spark):
    rows = [row(after=[cell("id", "1", True), cell("v", "a")]),
            row(after=[cell("id", "2", True), cell("v", "b")]),
            row(after=[cell("id", "1", True), cell("v", "c")])]
    routed = route(envelopes(spark, envelope(1, rows=rows)), routes(spark, ("t", "x", "id,v", None)))
    got = {r.key: (r.row_no, r.cur["v"]) for r in V.last_row_per_key(routed, F.lit(1)).collect()}
    assert got == {"1": (2, "c"), "2": (1, "b")}
    none = route(envelopes(spark, envelope(1, rows=rows)), routes(spark, ("t", "x", "v", None)))
    assert V.last_row_per_key(none, F.lit(1), "quarantine").count() == 0
    with pytest.raises(Exception, match="no key column found"):
        V.last_row_per_key(none, F.lit(1)).collect()


def test_readable_text_of_marks(spark):
    log = envelopes(
        spark,
        envelope(1, kind="TRANSACTIONBEGIN", tx_begin=dict(execute_time=0, transaction_id="", thread_id=3, props={})),
        envelope(2, kind="TRANSACTIONEND", tx_end=dict(execute_time=0, transaction_id="x", props={})),
        envelope(3, kind="HEARTBEAT"),
    )
    texts = {r.src_offset: r.text for r in V.readable(log, F.lit(1500)).collect()}
    assert texts[1].endswith('"delay time":500,"BEGIN ----> Thread id":3')
    assert texts[2].endswith('"END ----> Thread id":x')
    assert texts[3] is None


def test_change_keys(spark):
    records = spark.createDataFrame(
        [("d", "t", "INSERT", {"b": None, "a": "1"})], "db string, tab string, opt string, cur map<string,string>"
    )
    keyed = reconcile.record_keys(records, ["a", "missing", "b"])
    assert keyed.first().change_key == "d#t#1#null#INSERT"


def test_null_values_are_counted_apart_from_empty_ones(spark):
    cur = {"one": None, "two": "2", "three": None, "four": ""}
    records = spark.createDataFrame(
        [("d", "t", cur, {})],
        "db string, tab string, cur map<string,string>, src map<string,string>",
    )
    got = {r.name: (r.null_values, r.empty_values) for r in audit.null_audit(records).collect()}
    assert got == {"one": (1, 0), "two": (0, 0), "three": (1, 0), "four": (0, 1)}
