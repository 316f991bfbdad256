"""Hand-made envelopes."""

from __future__ import annotations

from rowtide.schemas import ENVELOPE


def cell(name, value="", key=False, updated=False, null=False, mysql_type="varchar(20)"):
    return dict(
        idx=0, sql_type=12, name=name, is_key=key, updated=updated, is_null=null,
        value="" if null else value, length=len(value or ""), mysql_type=mysql_type,
    )


def row(before=(), after=()):
    return dict(before=list(before), after=list(after))


def envelope(offset, seq=None, event="INSERT", rows=(), table="t", schema="s", partition=0,
             kind="ROWDATA", ddl=False, sql="", time=1000, ip="10.0.0.9", unset=False, **extra):
    batch, place = seq if seq is not None else (offset, 0)
    change = None
    if kind == "ROWDATA":
        change = dict(table_id=1, event_type=event, is_ddl=ddl, sql=sql, ddl_schema_name="",
                      row_datas=list(rows), props={})
    header = dict(
        version=1, logfile_name="binlog.1", logfile_offset=offset * 10, server_id=1,
        server_encode="UTF-8", execute_time=time, source_type="MYSQL", schema_name=schema,
        table_name=table, event_length=7, event_type=event, props={},
    )
    return dict(
        src_topic="changes", src_partition=partition, src_offset=offset, entry_type=kind,
        batch_id=None if unset else batch, in_id=None if unset else place, ip=ip, header=header,
        row_change=change, tx_begin=extra.get("tx_begin"), tx_end=extra.get("tx_end"),
    )


def envelopes(spark, *items):
    return spark.createDataFrame([tuple(i[n] for n in ENVELOPE.names) for i in items], ENVELOPE)


def routes(spark, *items):
    """(table, topic, primarykey, sensitive) of schema ``s``."""
    from rowtide.operators.routing import normalize_routes

    raw = spark.createDataFrame(
        [("s", t, topic, keys, hidden, "02") for t, topic, keys, hidden in items],
        "dbname string, tablename string, topic string, primarykey string, sensitive string, "
        "source_type string",
    )
    return normalize_routes(raw)
