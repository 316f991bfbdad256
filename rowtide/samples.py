"""A change log derived from the order table, for queries, tests and the benchmark.

Every order becomes one envelope and every envelope 0 to 3 changed rows. The derivation is a
projection: no shuffle, no group to collect, so it scales with the table whatever its keys.
The rules are listed in FIXTURES.md, part 3.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rowtide.schemas import CELLS, ENVELOPE

# name, is key, JDBC type, MySQL type, updated when, value before, value after
_CELLS = (
    ("order_key", True, -5, "bigint(20)", "false", "k", "k"),
    ("row_no", True, 4, "int(11)", "false", "i", "i"),
    ("product_id", False, -5, "bigint(20)", "false", "c", "c"),
    (
        "quantity", False, 4, "int(11)", "(k + i) % 2 = 0",
        "1 + (c + i) % 50 + if((k + i) % 2 = 0, 1, 0)", "1 + (c + i) % 50",
    ),
    (
        "price_cents", False, -5, "bigint(20)", "c % 3 = 0",
        "if(c % 3 = 0, null, cents + i)", "cents + i",
    ),
    (
        "return_flag", False, 1, "char(1)", "(c + i) % 5 = 0",
        "status", "if(c % 7 = 0, '', if((c + i) % 5 = 0, null, status))",
    ),
    ("created", False, 91, "date", "false", "order_day", "order_day"),
)


# An order changes at most this many rows.
_MOST_ROWS = 3


def _cell(position: int, side: int, row_no: int) -> str:
    name, is_key, sql_type, mysql_type, updated = _CELLS[position][:5]
    updated = re.sub(r"\bi\b", str(row_no), updated)
    value = re.sub(r"\bi\b", str(row_no), f"cast({_CELLS[position][5 + side]} as string)")
    return (
        f"named_struct('idx', {position}, 'sql_type', {sql_type}, 'name', '{name}', "
        f"'is_key', {str(is_key).lower()}, 'updated', {updated}, 'is_null', {value} is null, "
        f"'value', coalesce({value}, ''), 'length', length(coalesce({value}, '')), "
        f"'mysql_type', '{mysql_type}')"
    )


def _side(side: int, absent_for: str, row_no: int) -> str:
    cells = ", ".join(_cell(position, side, row_no) for position in range(len(_CELLS)))
    return f"if(event_type = '{absent_for}', cast(array() as {CELLS.simpleString()}), array({cells}))"


def change_log(orders: DataFrame) -> DataFrame:
    """Envelopes of the change log, replays included."""
    base = orders.selectExpr(
        "o_orderkey as k",
        "o_custkey as c",
        "o_orderstatus as status",
        "cast(round(o_totalprice * 100) as bigint) as cents",
        "cast(cast(o_orderdate as date) as string) as order_day",
        "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', "
        "cast(o_orderdate as timestamp_ntz)) + o_orderkey % 1000 as execute_time",
    )
    typed = base.selectExpr(
        "*",
        "case when k % 41 = 0 then 'TRANSACTIONEND' when k % 41 = 1 then 'TRANSACTIONBEGIN' "
        "when k % 101 = 2 then 'HEARTBEAT' else 'ROWDATA' end as entry_type",
        "case when k % 97 = 0 then 'ALTER' when k % 89 = 0 then 'QUERY' "
        "when status = 'O' then 'INSERT' when status = 'P' then 'UPDATE' "
        "else 'DELETE' end as event_type",
        "cast(if(k % 13 = 0, 0, 1 + k % 3) as int) as n_rows",
        # A replayed change comes again one offset later, with the sequence of an earlier one.
        "explode(if(k % 11 = 0 and k >= 8, array(0, 1), array(0))) as replay",
    )
    is_row = "entry_type = 'ROWDATA'"
    # Rows beyond n_rows are sliced off; null in their place, they are not computed first.
    rows = ", ".join(
        f"if(n_rows >= {i}, named_struct('before', {_side(0, 'INSERT', i)}, 'after', {_side(1, 'DELETE', i)}), null)"
        for i in range(1, _MOST_ROWS + 1)
    )
    row_datas = f"slice(array({rows}), 1, n_rows)"
    no_props = "cast(map() as map<string,string>)"
    log = typed.selectExpr(
        "'changes' as src_topic",
        "cast(k % 4 as int) as src_partition",
        "2 * k + replay as src_offset",
        "entry_type",
        "(k - 8 * replay) div 20 as batch_id",
        "(k - 8 * replay) % 20 as in_id",
        "concat('10.0.0.', k % 5) as ip",
        "named_struct('version', 1, 'logfile_name', concat('binlog.', lpad(k div 1000, 6, '0')), "
        "'logfile_offset', 4 + 200 * (k % 1000), 'server_id', cast(1 as bigint), "
        "'server_encode', 'UTF-8', 'execute_time', execute_time, 'source_type', 'MYSQL', "
        f"'schema_name', if({is_row}, 'shop', ''), "
        f"'table_name', if({is_row}, concat('orders_', k % 6), ''), 'event_length', 100 + k % 50, "
        f"'event_type', if({is_row}, event_type, 'UPDATE'), 'props', {no_props}) as header",
        # The condition is on the fields, not on the struct: one field is then read without
        # computing the others.
        f"named_struct('table_id', if({is_row}, k % 6, null), "
        f"'event_type', if({is_row}, event_type, null), "
        f"'is_ddl', if({is_row}, event_type = 'ALTER', null), "
        f"'sql', if({is_row}, if(event_type = 'ALTER', "
        "concat('alter table orders_', k % 6, ' add c', k), ''), null), "
        f"'ddl_schema_name', if({is_row}, '', null), 'row_datas', if({is_row}, {row_datas}, null), "
        f"'props', {no_props}) as row_change",
        "if(entry_type = 'TRANSACTIONBEGIN', named_struct('execute_time', cast(0 as bigint), "
        f"'transaction_id', '', 'thread_id', k, 'props', {no_props}), null) as tx_begin",
        "if(entry_type = 'TRANSACTIONEND', named_struct('execute_time', cast(0 as bigint), "
        f"'transaction_id', concat('tx', k), 'props', {no_props}), null) as tx_end",
    )
    return log.select(*ENVELOPE.fieldNames())


# table, topic, primarykey, sensitive
ROUTE_LIST = (
    ("orders_0", "mysql_a", "order_key,row_no", None),
    ("orders_1", "mysql_a", "row_no,order_key", "return_flag"),
    ("orders_2", "mysql_b", "order_key,return_flag", None),
    ("orders_3", "mysql_c", "product_id", "price_cents,product_id"),
)


def route_table(spark: SparkSession, rows=ROUTE_LIST) -> DataFrame:
    """The routes as raw text columns, the way a configuration table holds them."""
    names = ("dbname", "tablename", "topic", "primarykey", "sensitive", "source_type")
    lines = [("shop", *row, "02") for row in rows]
    table = pa.table(
        {n: pa.array([line[i] for line in lines], pa.string()) for i, n in enumerate(names)}
    )
    return spark.createDataFrame(table)


def fetch_log(events: DataFrame) -> DataFrame:
    """One row per fetched message: when, how large, and how far the source had come."""
    return events.selectExpr(
        "cast(ts as timestamp_ntz) as fetch_ts",
        "cast(user_id % 4 as int) as src_partition",
        "event_id + 1 as next_offset",
        "cast(length(props) as bigint) as n_bytes",
        "event_id + 1 + user_id % 5 - if(event_id % 17 = 0, 10, 0) as latest_offset",
    )


def _meta_entry(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in fields.items()) + ")"


def job_configs(customer: DataFrame) -> DataFrame:
    """One routing document per customer, in the three layouts; every fourth repeats a table."""
    table = "concat('t_', c_custkey % 7)"
    database = "concat('db_', c_nationkey)"
    none = "cast(null as string)"
    first = _meta_entry(
        dbname=database, tablename=table, primarykey="'id,name'", sourceType="'02'",
        topic="concat('topic_', c_custkey % 5)", sensitive="'phone,,email'",
    )
    second = _meta_entry(
        dbname=database, tablename="concat('u_', c_custkey % 3)", primarykey="'id, no,,'",
        sourceType="'03'", topic="'topic_u'", sensitive=none,
    )
    again = _meta_entry(
        dbname=database, tablename=table, primarykey="'code'", sourceType="'04'",
        topic="'topic_late'", sensitive=none,
    )
    meta = f"if(c_custkey % 4 = 0, array({first}, {second}, {again}), array({first}, {second}))"
    return customer.selectExpr("c_custkey", f"{meta} as meta").selectExpr(
        "concat('job_', c_custkey) as job",
        "case c_custkey % 3 "
        "when 0 then to_json(named_struct('data', named_struct('db_tab_meta', meta))) "
        "when 1 then to_json(named_struct('db_tab_meta', meta)) else to_json(meta) end as config",
    )


def repeated_routes(customer: DataFrame) -> DataFrame:
    """Jobs that name the same tables: each customer's one entry of a table of the log, topics by job."""
    entry = _meta_entry(
        dbname="'shop'", tablename="concat('orders_', c_custkey % 4)", primarykey="'order_key,row_no'",
        sourceType="'02'", topic="concat('topic_', lpad(c_custkey, 9, '0'))",
        sensitive="if(c_custkey % 8 = 1, 'quantity', if(c_custkey % 8 = 5, 'price_cents', null))",
    )
    return customer.selectExpr(
        "concat('job_', lpad(c_custkey, 9, '0')) as job",
        f"to_json(named_struct('db_tab_meta', array({entry}))) as config",
    )


def sensitive_documents(customer: DataFrame) -> DataFrame:
    """One sensitive-field document per customer; some entries name no fields."""
    entry = _meta_entry(
        dbname="concat('db_', c_nationkey)", tablename="concat('t_', c_custkey % 7)",
        sensefield="if(c_custkey % 5 = 0, null, concat('phone,,f_', c_custkey % 9, ','))",
    )
    return customer.selectExpr(
        "concat('job_', c_custkey) as job",
        "to_json(named_struct('info', named_struct('content', "
        f"named_struct('db_tab_meta', array({entry}))))) as config",
    )


def position_texts(customer: DataFrame) -> DataFrame:
    """One position text per customer; some are empty or malformed."""
    return customer.selectExpr(
        "concat('job_', c_custkey) as job",
        "case c_custkey % 10 when 0 then '' when 1 then 'bad:1:2' when 2 then 'changes:0:5:1:2:' "
        "else concat_ws(':', 'changes', c_custkey % 4, c_custkey * 10, c_custkey, "
        "c_custkey % 20, c_custkey * 3) end as position",
    )


def stored_events(events: DataFrame) -> DataFrame:
    """The event table as stored message bytes; a few rows hold none, a few of length 0."""
    return events.selectExpr(
        "event_id as event_row",
        "cast(if(event_id % 997 = 500, null, if(event_id % 499 = 3, '', props)) as binary) as event_bytes",
    )


def event_messages(events: DataFrame) -> DataFrame:
    """The event table as messages of a topic of four partitions."""
    return events.selectExpr(
        "'events' as src_topic", "cast(event_id % 4 as int) as src_partition", "event_id div 4 as src_offset",
        "cast(ts as timestamp) as timestamp", "cast(props as binary) as value",
    )


def json_messages(records: DataFrame) -> DataFrame:
    """The records as JSON changes; every other message carries its data as escaped text."""
    data = (
        "named_struct('schema', db, 'table', tab, 'operation', opt, 'fields', cur)"
    )
    return records.selectExpr(
        "src_partition",
        "src_offset",
        "row_no",
        "cast(cus['dmlts'] as bigint) as execute_time",
        f"if(src_offset % 4 = 0, to_json(named_struct('data', to_json({data}))), "
        f"to_json(named_struct('data', {data}))) as value",
    )


def watch_list(part: DataFrame) -> DataFrame:
    """Watched product ids: those of large parts."""
    return part.where("p_size > 40").selectExpr("cast(p_partkey as string) as value")
