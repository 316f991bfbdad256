"""SQL that gives the rows of the registered queries, written flat over the given tables."""

from __future__ import annotations

from checks.queries import NOW, TS

_LOG = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    strftime(o_orderdate, '%Y-%m-%d') AS order_day,
    epoch_ms(o_orderdate) + o_orderkey % 1000 AS execute_time,
    CASE WHEN o_orderkey % 41 = 0 THEN 'TRANSACTIONEND'
         WHEN o_orderkey % 41 = 1 THEN 'TRANSACTIONBEGIN'
         WHEN o_orderkey % 101 = 2 THEN 'HEARTBEAT' ELSE 'ROWDATA' END AS entry_type,
    CASE WHEN o_orderkey % 97 = 0 THEN 'ALTER' WHEN o_orderkey % 89 = 0 THEN 'QUERY'
         WHEN o_orderstatus = 'O' THEN 'INSERT' WHEN o_orderstatus = 'P' THEN 'UPDATE'
         ELSE 'DELETE' END AS raw_type,
    CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 1 + o_orderkey % 3 END AS n
  FROM orders),
env AS (
  SELECT base.*, r AS replay, CAST(k % 4 AS INTEGER) AS src_partition, 2 * k + r AS src_offset,
    (k - 8 * r) // 20 AS batch_id, (k - 8 * r) % 20 AS in_id,
    ((k - 8 * r) // 20) * 100 + (k - 8 * r) % 20 AS seq,
    '10.0.0.' || (k % 5) AS ip,
    CASE WHEN entry_type = 'ROWDATA' THEN 'shop' ELSE '' END AS db,
    CASE WHEN entry_type = 'ROWDATA' THEN 'orders_' || (k % 6) ELSE '' END AS tab,
    CASE WHEN entry_type = 'ROWDATA' THEN raw_type ELSE 'UPDATE' END AS ev,
    entry_type = 'ROWDATA' AND raw_type = 'ALTER' AS is_ddl,
    CASE WHEN entry_type = 'ROWDATA' THEN n ELSE 0 END AS n_rows,
    CASE WHEN entry_type = 'ROWDATA' AND raw_type <> 'ALTER' THEN n ELSE 0 END AS n_emit,
    CASE WHEN entry_type = 'ROWDATA' AND raw_type = 'ALTER'
         THEN 'alter table orders_' || (k % 6) || ' add c' || k ELSE '' END AS sql_text,
    entry_type = 'TRANSACTIONEND' OR (entry_type = 'ROWDATA' AND raw_type = 'ALTER') AS is_end,
    'binlog.' || lpad(CAST(k // 1000 AS VARCHAR), 6, '0') AS logfile_name,
    4 + 200 * (k % 1000) AS now_pos, 4 + 200 * (k % 1000) + 100 + k % 50 AS next_pos
  FROM base, (VALUES (0), (1)) AS again(r)
  WHERE r = 0 OR (k % 11 = 0 AND k >= 8)),
flagged AS (
  SELECT *, coalesce(seq <= max(seq) OVER earlier, false) AS is_repeat FROM env
  WINDOW earlier AS (PARTITION BY src_partition ORDER BY src_offset
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS (SELECT * FROM flagged WHERE NOT is_repeat),
routes(rtab, topic, keys, sens) AS (VALUES
  ('orders_0', 'mysql_a', ['order_key', 'row_no'], CAST([] AS VARCHAR[])),
  ('orders_1', 'mysql_a', ['row_no', 'order_key'], ['return_flag']),
  ('orders_2', 'mysql_b', ['order_key', 'return_flag'], CAST([] AS VARCHAR[])),
  ('orders_3', 'mysql_c', ['product_id'], ['price_cents', 'product_id'])),
routed AS (SELECT kept.*, topic, keys, sens FROM kept JOIN routes ON db || '.' || tab = 'shop.' || rtab)
"""

# Cells of a set of envelopes: one row per row and column, with the before and after text.
_CELLS = """
{name}_rows AS (SELECT {source}.*, i FROM {source}, unnest(range(1, {count} + 1)) AS rows_(i)),
{name} AS (
  SELECT r.*, CAST(i - 1 AS INTEGER) AS row_no, idx, name, is_key, mysql_type,
    CASE name WHEN 'quantity' THEN (k + i) % 2 = 0 WHEN 'price_cents' THEN c % 3 = 0
      WHEN 'return_flag' THEN (c + i) % 5 = 0 ELSE false END AS updated,
    CASE name WHEN 'order_key' THEN CAST(k AS VARCHAR) WHEN 'row_no' THEN CAST(i AS VARCHAR)
      WHEN 'product_id' THEN CAST(c AS VARCHAR)
      WHEN 'quantity' THEN CAST(1 + (c + i) % 50 + CASE WHEN (k + i) % 2 = 0 THEN 1 ELSE 0 END AS VARCHAR)
      WHEN 'price_cents' THEN CASE WHEN c % 3 = 0 THEN NULL ELSE CAST(cents + i AS VARCHAR) END
      WHEN 'return_flag' THEN status ELSE order_day END AS bv,
    CASE name WHEN 'order_key' THEN CAST(k AS VARCHAR) WHEN 'row_no' THEN CAST(i AS VARCHAR)
      WHEN 'product_id' THEN CAST(c AS VARCHAR)
      WHEN 'quantity' THEN CAST(1 + (c + i) % 50 AS VARCHAR)
      WHEN 'price_cents' THEN CAST(cents + i AS VARCHAR)
      WHEN 'return_flag' THEN CASE WHEN c % 7 = 0 THEN '' WHEN (c + i) % 5 = 0 THEN NULL ELSE status END
      ELSE order_day END AS av,
    ev <> 'INSERT' AS has_before, ev <> 'DELETE' AS has_after
  FROM {name}_rows r, (VALUES
    (0, 'order_key', true, 'bigint(20)'), (1, 'row_no', true, 'int(11)'),
    (2, 'product_id', false, 'bigint(20)'), (3, 'quantity', false, 'int(11)'),
    (4, 'price_cents', false, 'bigint(20)'), (5, 'return_flag', false, 'char(1)'),
    (6, 'created', false, 'date')) AS cols(idx, name, is_key, mysql_type))
"""

_ROUTED_CELLS = _CELLS.format(name="cells", source="routed", count="n_emit")
_ALL_CELLS = _CELLS.format(name="all_cells", source="env", count="n_rows")


def _images(cells: str = "cells", name: str = "images", update: str = "changed",
            null: str = "keep", sensitive: bool = True) -> str:
    """The src and cur images in long form."""
    bv, av = ("bv", "av") if null == "keep" else ("coalesce(bv, '')", "coalesce(av, '')")
    visible = "NOT list_contains(sens, name)" if sensitive else "true"
    changed = (
        "(updated OR is_key OR list_contains(keys, name))" if update == "changed" else "true"
    )
    return f"""
{name} AS (
  SELECT *, 'src' AS side, {bv} AS value FROM {cells}
  WHERE {visible} AND ev IN ('UPDATE', 'DELETE')
  UNION ALL
  SELECT *, 'cur' AS side, CASE WHEN ev = 'DELETE' THEN {bv} ELSE {av} END AS value FROM {cells}
  WHERE {visible} AND (ev = 'INSERT' OR (ev = 'DELETE' AND is_key) OR (ev = 'UPDATE' AND {changed})))
"""


def _records(update: str = "changed", null: str = "keep", sensitive: bool = True,
             source: str = "routed") -> str:
    """Per row: key, dumped maps, record id and sizes."""
    visible = "NOT list_contains(sens, name)" if sensitive else "true"
    pair = "'[' || name || ',' || coalesce(value, 'null') || ']'"
    entry = f"{_text_size('name')} + 1 + coalesce({_text_size('value')}, 0)"
    entry_hex = f"{_text_hex('name')} || coalesce('00' || {_text_hex('value')}, '02')"
    return (
        _CELLS.format(name="cells", source=source, count="n_emit")
        + ","
        + _images(update=update, null=null, sensitive=sensitive)
        + f""",
row_keys AS (
  SELECT src_partition, src_offset, row_no,
    string_agg(coalesce(CASE WHEN ev = 'DELETE' THEN bv ELSE av END, ''), chr(1) ORDER BY idx)
      FILTER (WHERE {visible} AND list_contains(keys, name) AND ev IN ('INSERT', 'UPDATE', 'DELETE')) AS key
  FROM cells GROUP BY ALL),
maps AS (
  SELECT src_partition, src_offset, row_no,
    string_agg({pair}, '' ORDER BY name) FILTER (WHERE side = 'src') AS src,
    string_agg({pair}, '' ORDER BY name) FILTER (WHERE side = 'cur') AS cur,
    count(*) FILTER (WHERE side = 'src') AS src_n, count(*) FILTER (WHERE side = 'cur') AS cur_n,
    string_agg({entry_hex}, '' ORDER BY idx) FILTER (WHERE side = 'src') AS src_hex,
    string_agg({entry_hex}, '' ORDER BY idx) FILTER (WHERE side = 'cur') AS cur_hex,
    coalesce(sum({entry}) FILTER (WHERE side = 'src'), 0) AS src_bytes,
    coalesce(sum({entry}) FILTER (WHERE side = 'cur'), 0) AS cur_bytes
  FROM images GROUP BY ALL),
mids AS (
  SELECT src_partition, src_offset, coalesce(CAST(sum(n_emit) OVER (
      PARTITION BY src_partition ORDER BY src_offset
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS first_mid
  FROM {source}),
records AS (
  SELECT r.*, CAST(i - 1 AS INTEGER) AS row_no, row_keys.key, mids.first_mid + i - 1 AS mid,
    coalesce(src, '') AS src, coalesce(cur, '') AS cur, coalesce(src_n, 0) AS src_n,
    coalesce(cur_n, 0) AS cur_n, coalesce(src_bytes, 0) AS src_bytes,
    coalesce(cur_bytes, 0) AS cur_bytes, src_hex, cur_hex
  FROM cells_rows r
  JOIN row_keys ON r.src_partition = row_keys.src_partition AND r.src_offset = row_keys.src_offset
    AND r.i - 1 = row_keys.row_no
  JOIN mids ON r.src_partition = mids.src_partition AND r.src_offset = mids.src_offset
  LEFT JOIN maps ON r.src_partition = maps.src_partition AND r.src_offset = maps.src_offset
    AND r.i - 1 = maps.row_no)
"""
    )


def _long_size(value: str) -> str:
    """Bytes of a zig-zag variable-length integer that is not negative."""
    cases = " ".join(f"WHEN {value} < {1 << (7 * n - 1)} THEN {n}" for n in range(1, 10))
    return f"(CASE {cases} ELSE 10 END)"


def _text_size(value: str) -> str:
    return f"({_long_size(f'strlen({value})')} + strlen({value}))"


def _map_size(entries: str, size: str) -> str:
    return f"(2 + CASE WHEN {entries} > 0 THEN {_long_size(entries)} + {size} ELSE 0 END)"


def _long_hex(value: str) -> str:
    """Hex of a zig-zag variable-length integer that is not negative, up to 8 bytes."""
    byte = lambda i, more: f"printf('%02X', ((2 * ({value})) >> {7 * i}) & 127 | {128 if more else 0})"
    cases = " ".join(
        f"WHEN {value} < {1 << (7 * n - 1)} THEN " + " || ".join(byte(i, i + 1 < n) for i in range(n)) for n in range(1, 9)
    )
    return f"(CASE {cases} END)"


def _text_hex(value: str) -> str:
    return f"({_long_hex(f'strlen({value})')} || hex({value}))"


def _map_hex(entries: str, cells: str) -> str:
    return f"('00' || CASE WHEN {entries} > 0 THEN {_long_hex(entries)} || {cells} ELSE '' END || '00')"


_CUS_HEX = (
    f"({_text_hex(chr(39) + 'dmlts' + chr(39))} || '00' || {_text_hex('CAST(execute_time AS VARCHAR)')} || "
    f"{_text_hex(chr(39) + 'ip' + chr(39))} || '00' || {_text_hex('ip')})"
)
_RECORD_HEX = (
    f"({_long_hex('mid')} || {_text_hex('db')} || {_text_hex('db')} || {_text_hex('tab')} || {_text_hex('ev')} || "
    f"{_long_hex(str(TS))} || '0000' || '0000' || {_map_hex('src_n', 'src_hex')} || {_map_hex('cur_n', 'cur_hex')} || "
    f"{_map_hex('2', _CUS_HEX)})"
)
_CUS_SIZE = (
    f"({_text_size(chr(39) + 'dmlts' + chr(39))} + {_text_size(chr(39) + 'ip' + chr(39))} + 2 + "
    f"{_text_size('CAST(execute_time AS VARCHAR)')} + {_text_size('ip')})"
)
_RECORD_SIZE = (
    f"({_long_size('mid')} + {_long_size(str(TS))} + 2 * {_text_size('db')} + {_text_size('tab')} + "
    f"{_text_size('ev')} + 4 + {_map_size('src_n', 'src_bytes')} + {_map_size('cur_n', 'cur_bytes')} + "
    f"{_map_size('2', _CUS_SIZE)})"
)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_ON_LOG = _with(_LOG)
_ON_CELLS = _with(_LOG, _ROUTED_CELLS)
_ON_IMAGES = _with(_LOG, _ROUTED_CELLS, _images())
_ON_RECORDS = _with(_LOG, _records())

# Envelope grain: the image of the last row, NULL as empty text, no maps on updates.
_LAST_ROW = """
last_maps AS (
  SELECT src_partition, src_offset,
    string_agg('[' || name || ',' || value || ']', '' ORDER BY name) FILTER (WHERE side = 'src') AS src,
    string_agg('[' || name || ',' || value || ']', '' ORDER BY name) FILTER (WHERE side = 'cur') AS cur,
    count(*) FILTER (WHERE side = 'src') AS src_n, count(*) FILTER (WHERE side = 'cur') AS cur_n,
    string_agg({entry_hex}, '' ORDER BY idx) FILTER (WHERE side = 'src') AS src_hex,
    string_agg({entry_hex}, '' ORDER BY idx) FILTER (WHERE side = 'cur') AS cur_hex
  FROM (
    SELECT *, 'src' AS side, coalesce(bv, '') AS value FROM all_cells WHERE ev = 'DELETE'
    UNION ALL
    SELECT *, 'cur' AS side, coalesce(CASE WHEN ev = 'DELETE' THEN bv ELSE av END, '') AS value
    FROM all_cells WHERE ev = 'INSERT' OR (ev = 'DELETE' AND is_key))
  WHERE i = n_rows GROUP BY ALL),
whole AS (
  SELECT env.*, n_rows > 0 AND ev <> 'UPDATE' AS mapped, coalesce(src, '') AS src_text,
    coalesce(cur, '') AS cur_text, coalesce(src_n, 0) AS src_n, coalesce(cur_n, 0) AS cur_n,
    src_hex, cur_hex
  FROM env LEFT JOIN last_maps USING (src_partition, src_offset))
""".format(entry_hex=f"{_text_hex('name')} || '00' || {_text_hex('value')}")

_WHOLE_HEX = (
    f"('00' || {_text_hex('db')} || {_text_hex('db')} || {_text_hex('tab')} || {_text_hex('ev')} || {_long_hex(str(TS))} || "
    f"'00' || {_text_hex('sql_text')} || '0000' || "
    f"CASE WHEN mapped THEN {_map_hex('src_n', 'src_hex')} || {_map_hex('cur_n', 'cur_hex')} ELSE '0202' END || '02')"
)

_FIRST_CELL = """
first_after AS (
  SELECT src_partition, src_offset, name || ' ## ' || coalesce(av, '') AS info
  FROM all_cells WHERE idx = 0 AND has_after AND i = n_rows),
summary AS (
  SELECT src_partition, src_offset, batch_id // 100 AS flush_no, entry_type, logfile_name, now_pos,
    next_pos, db AS schema_name, tab AS table_name, coalesce(info, 'null') AS column_info, ev AS op
  FROM env LEFT JOIN first_after USING (src_partition, src_offset))
"""

_RENDERED = f"""
texts AS (
  SELECT src_partition, src_offset, row_no,
    '[' || coalesce(string_agg('"' || name || '":' || coalesce(bv, '') || ',"type=":' || mysql_type ||
      CASE WHEN updated THEN ',"update":true' ELSE '' END, '|' ORDER BY idx) FILTER (WHERE has_before), '') || ']' AS before_text,
    '[' || coalesce(string_agg('"' || name || '":' || coalesce(av, '') || ',"type=":' || mysql_type ||
      CASE WHEN updated THEN ',"update":true' ELSE '' END, '|' ORDER BY idx) FILTER (WHERE has_after), '') || ']' AS after_text,
    '[' || coalesce(string_agg(CASE WHEN is_key OR updated THEN '"' || name || '":' || coalesce(av, '') ||
      ',"type":' || mysql_type ELSE '' END, '|' ORDER BY idx) FILTER (WHERE has_after), '') || ']' AS changed_text,
    any_value(ev) AS ev
  FROM all_cells GROUP BY ALL),
bodies AS (
  SELECT src_partition, src_offset, string_agg(
    CASE ev WHEN 'DELETE' THEN before_text WHEN 'INSERT' THEN after_text
      ELSE before_text || after_text || changed_text END, '' ORDER BY row_no) AS body
  FROM texts GROUP BY ALL),
readable AS (
  SELECT src_partition, src_offset, entry_type,
    CASE entry_type
      WHEN 'TRANSACTIONBEGIN' THEN '{{"binlog name":' || logfile_name || ',"log file offset":' || now_pos ||
        ',"execute time":' || execute_time || ',"delay time":' || ({NOW} - execute_time) ||
        ',"BEGIN ----> Thread id":' || k
      WHEN 'TRANSACTIONEND' THEN '{{"binlog name":' || logfile_name || ',"log file offset":' || now_pos ||
        ',"execute time":' || execute_time || ',"delay time":' || ({NOW} - execute_time) ||
        ',"END ----> Thread id":tx' || k
      WHEN 'ROWDATA' THEN '{{"binlog name":' || logfile_name || ',"log file offset":' || now_pos ||
        ',"schema name":' || db || ',"table name":' || tab || ',"event type":' || ev ||
        ',"execute time":' || execute_time || ',"delay time":' || ({NOW} - execute_time) ||
        CASE WHEN is_ddl THEN ',"SQL:"' || sql_text ELSE '' END || coalesce(body, '')
    END AS text
  FROM env LEFT JOIN bodies USING (src_partition, src_offset))
"""

_NUMBERED = """
counted AS (
  SELECT {source}.*, row_number() OVER ordered - 1 AS ordinal,
    coalesce(CAST(sum(CASE WHEN is_end THEN 1 ELSE 0 END) OVER earlier AS BIGINT), 0) AS ends,
    coalesce(CAST(sum(n_emit) OVER earlier AS BIGINT), 0) AS first_mid
  FROM {source}
  WINDOW ordered AS (PARTITION BY src_partition ORDER BY src_offset),
    earlier AS (PARTITION BY src_partition ORDER BY src_offset
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY src_partition, ends ORDER BY src_offset) - 1 AS place
  FROM counted)
"""

# 31 ^ e modulo 2 ^ 32 for the hash of a text.
_POWERS = " UNION ALL ".join(f"SELECT {e} AS e, {pow(31, e, 1 << 32)} AS p31" for e in range(64))

# The last job of a table counts, and the sensitive lists of all its jobs.
_REROUTED = """
rerouted AS (
  SELECT env.*, j.topic, ['order_key', 'row_no'] AS keys, coalesce(j.sens_, CAST([] AS VARCHAR[])) AS sens FROM env JOIN (
    SELECT 'orders_' || (c_custkey % 4) AS rtab, 'topic_' || lpad(CAST(max(c_custkey) AS VARCHAR), 9, '0') AS topic,
      list_distinct(list(CASE c_custkey % 8 WHEN 1 THEN 'quantity' WHEN 5 THEN 'price_cents' END)
        FILTER (WHERE c_custkey % 8 IN (1, 5))) AS sens_
    FROM customer GROUP BY 1) AS j ON db || '.' || tab = 'shop.' || j.rtab)
"""

_FLUSHED = "flushed AS (SELECT *, batch_id // 100 AS flush_no FROM routed)"
_REPORTED = f"""
listed AS (
  SELECT flush_no, topic, arg_max({NOW} - execute_time, src_offset) AS raw_delay_ms
  FROM flushed GROUP BY flush_no, topic
  UNION ALL
  SELECT flush_no, 'DELAY_TIMES', arg_max({NOW} - execute_time, src_offset)
  FROM flushed GROUP BY flush_no),
reported AS (
  SELECT l.flush_no, l.topic, l.raw_delay_ms, b.raw_delay_ms AS reported_delay_ms
  FROM listed l JOIN listed b ON l.flush_no = b.flush_no AND b.topic = 'DELAY_TIMES')
"""
_FETCHED = """
fetched AS (
  SELECT ts AS fetch_ts, CAST(user_id % 4 AS INTEGER) AS src_partition, event_id + 1 AS next_offset,
    CAST(length(props) AS BIGINT) AS n_bytes,
    event_id + 1 + user_id % 5 - CASE WHEN event_id % 17 = 0 THEN 10 ELSE 0 END AS latest_offset,
    date_trunc('minute', ts) AS minute
  FROM events)
"""
_CONFIGS = """
entries AS (
  SELECT 'job_' || c_custkey AS job, c_custkey, 0 AS pos, 'db_' || c_nationkey AS dbname,
    't_' || (c_custkey % 7) AS tablename, 'id|name' AS key_columns, '02' AS source_type,
    'topic_' || (c_custkey % 5) AS topic, 'phone|email' AS sensitive FROM customer
  UNION ALL
  SELECT 'job_' || c_custkey, c_custkey, 1, 'db_' || c_nationkey, 'u_' || (c_custkey % 3),
    'id| no', '03', 'topic_u', NULL FROM customer
  UNION ALL
  SELECT 'job_' || c_custkey, c_custkey, 2, 'db_' || c_nationkey, 't_' || (c_custkey % 7),
    'code', '04', 'topic_late', NULL FROM customer WHERE c_custkey % 4 = 0),
route_list AS (
  SELECT job, c_custkey, dbname, tablename, arg_max(topic, pos) AS topic,
    arg_max(source_type, pos) AS source_type, arg_max(key_columns, pos) AS key_columns,
    arg_max(sensitive, pos) FILTER (WHERE sensitive IS NOT NULL) AS sensitive
  FROM entries GROUP BY ALL)
"""

_ROW = "src_partition, src_offset, row_no"
_CELL_ROW = f"{_ROW}, side, name, value"
_DELIVERED = "(src_offset // 2) % 50 <> 7"
_OPTION_FIELDS = "CAST(k AS VARCHAR) || '#' || CAST(i AS VARCHAR) || '#'"
_BOTH_KEYS = (
    f"db || '#' || tab || '#' || CASE WHEN cur_n > 0 THEN {_OPTION_FIELDS} ELSE '' END || ev"
)
_NO_ROUTES_LOG = _with(_LOG, _NUMBERED.format(source="kept"))



def _topic_json(name: str, value: str) -> str:
    return (
        f"'{{' || string_agg('\"' || {name} || '\":' || {value}, ',' ORDER BY {name}) || '}}'"
    )


def oracles() -> dict[str, str]:
    sql = {
        "s1_tail_from_position": f"""{_ON_LOG},
            starts AS (SELECT src_partition AS p, max(src_offset) // 2 AS start FROM env GROUP BY 1)
            SELECT src_partition, src_offset, batch_id, in_id FROM env
            JOIN starts ON src_partition = p WHERE src_offset >= start""",
        "s2_read_from_offset": f"""{_ON_LOG}
            SELECT 'earliest' AS start, count(*) AS envelopes, min(src_offset) AS first_offset FROM env
            UNION ALL SELECT '1000', count(*), min(src_offset) FROM env WHERE src_offset >= 1000
            UNION ALL SELECT 'latest', 0, NULL""",
        "s3_resolve_position": """
            WITH texts AS (
              SELECT 'job_' || c_custkey AS job, c_custkey AS k, CASE c_custkey % 10 WHEN 0 THEN ''
                WHEN 1 THEN 'bad:1:2' WHEN 2 THEN 'changes:0:5:1:2:'
                ELSE 'changes:' || (c_custkey % 4) || ':' || (c_custkey * 10) || ':' || c_custkey ||
                  ':' || (c_custkey % 20) || ':' || (c_custkey * 3) END AS position,
                c_custkey % 10 > 2 AS ok, c_custkey % 10 = 0 AS blank
              FROM customer)
            SELECT job, position,
              CASE WHEN ok THEN 'ok' WHEN blank AND form = 'lenient' THEN 'latest' ELSE 'error' END AS status,
              CASE WHEN ok THEN 'changes' END AS src_topic,
              CAST(CASE WHEN ok THEN k % 4 END AS INTEGER) AS src_partition,
              CASE WHEN ok THEN k * 10 END AS next_offset,
              CASE WHEN ok THEN k WHEN blank AND form = 'lenient' THEN 0 END AS batch_id,
              CASE WHEN ok THEN k % 20 WHEN blank AND form = 'lenient' THEN 0 END AS in_id,
              CASE WHEN ok THEN k * 3 WHEN blank AND form = 'lenient' THEN 0 ELSE 7 END AS mid,
              form
            FROM texts, (VALUES ('strict'), ('lenient')) AS forms(form)""",
        "s4_clamp_offset": """
            WITH e AS (SELECT event_id, event_id AS requested, user_id * 20 AS earliest,
              user_id * 20 + 3000 AS latest, event_id % 3 > 0 AS flagged FROM events)
            SELECT event_id,
              CASE WHEN NOT flagged THEN requested WHEN requested > latest THEN latest
                WHEN requested < earliest THEN earliest ELSE latest END AS clamped,
              CASE WHEN flagged THEN latest ELSE requested END AS older_form FROM e""",
        "s5_range_scan": """
            WITH e AS (SELECT event_id AS event_row, CASE WHEN event_id % 997 = 500 THEN NULL
                WHEN event_id % 499 = 3 THEN '' ELSE props END AS event_text FROM events),
            begun AS (SELECT *, coalesce(1 + max(event_row) FILTER (WHERE event_text IS NULL) OVER earlier, 0) AS begin_
              FROM e WINDOW earlier AS (ORDER BY event_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            ended AS (SELECT *, coalesce(sum(ceil((event_row - begin_) / 300.0)) FILTER (WHERE event_text IS NULL)
                OVER (ORDER BY event_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS scans FROM begun)
            SELECT CAST(scans AS BIGINT) + (event_row - begin_) // 300 AS scan_no, event_row, event_text
            FROM ended WHERE event_text IS NOT NULL""",
        "s7_decode_envelopes": f"""{_with(_LOG, _ALL_CELLS)},
            sides AS (
              SELECT src_partition, src_offset, row_no, 'before' AS side, name,
                coalesce(bv, '') AS value, bv IS NULL AS is_null, is_key, updated, mysql_type
              FROM all_cells WHERE has_before
              UNION ALL
              SELECT src_partition, src_offset, row_no, 'after', name, coalesce(av, ''),
                av IS NULL, is_key, updated, mysql_type FROM all_cells WHERE has_after)
            SELECT src_partition, src_offset, entry_type, batch_id, in_id, ip, tab AS table_name,
              execute_time, CASE WHEN entry_type = 'ROWDATA' THEN is_ddl END AS is_ddl,
              CASE WHEN entry_type = 'ROWDATA' THEN ev END AS event_type,
              row_no, side, name, value, is_null, is_key, updated, mysql_type
            FROM env LEFT JOIN sides USING (src_partition, src_offset)""",
        "s8_decode_records": f"""{_with(_LOG, _records())}
            SELECT src_partition, src_offset, row_no, first_mid + row_no AS mid, db, tab, ev AS opt,
              CAST({TS} AS BIGINT) AS ts, '' AS ddl, '' AS err, side, name, value
            FROM images JOIN mids USING (src_partition, src_offset)""",
        "s9_decode_json": f"""{_ON_RECORDS}
            SELECT {_ROW}, db AS schema, tab AS "table", ev AS operation, cur AS fields FROM records""",
        "s10_load_routes": f"""{_with(_CONFIGS)}
            SELECT job, dbname, tablename, topic, source_type, key_columns, sensitive FROM route_list""",
        "s11_load_routes_array": f"""{_with(_CONFIGS)}
            SELECT job, dbname, tablename, topic, source_type, key_columns FROM route_list
            WHERE c_custkey % 3 = 2""",
        "s12_load_sensitive": """
            SELECT 'job_' || c_custkey AS job, 'db_' || c_nationkey AS dbname,
              't_' || (c_custkey % 7) AS tablename, 'phone|f_' || (c_custkey % 9) AS sensitive
            FROM customer WHERE c_custkey % 5 <> 0""",
        "f1_drop_repeats": f"{_ON_LOG} SELECT src_partition, src_offset, batch_id, in_id FROM kept",
        "f1_repeat_counts": f"""{_ON_LOG}
            SELECT 'changes' AS src_topic, src_partition, count(*) AS envelopes,
              count(*) FILTER (WHERE is_repeat) AS repeats FROM flagged GROUP BY src_partition""",
        "f1_two_topics": f"""{_ON_LOG}
            SELECT src_topic, src_partition, src_offset + more AS src_offset, batch_id, in_id
            FROM kept, (VALUES ('changes', 0), ('more_changes', 3)) AS topics(src_topic, more)""",
        "n3_two_topics": f"""{_with(_LOG, _NUMBERED.format(source="routed"))}
            SELECT src_topic, src_partition, src_offset + more AS src_offset, ends AS out_batch_id,
              place AS out_in_id, first_mid
            FROM numbered, (VALUES ('changes', 0), ('more_changes', 3)) AS topics(src_topic, more)""",
        "f2_repeated_routes": f"""{_with(_LOG, _REROUTED)},
            {_CELLS.format(name="cells", source="rerouted", count="n_emit")}, {_images()}
            SELECT topic, 'rows' AS part, CAST(sum(n_emit) AS BIGINT) AS n FROM rerouted GROUP BY topic HAVING sum(n_emit) > 0
            UNION ALL SELECT topic, 'records', CAST(sum(n_emit) AS BIGINT) FROM rerouted GROUP BY topic HAVING sum(n_emit) > 0
            UNION ALL SELECT topic, 'cells', count(*) FROM images WHERE side = 'cur' GROUP BY topic""",
        "f2_route_filter": f"{_ON_LOG} SELECT src_partition, src_offset, topic FROM routed",
        "f2b_default_topic": f"""{_ON_LOG}
            SELECT 'mysql_all' AS topic, entry_type, count(*) AS envelopes FROM kept GROUP BY ALL""",
        "f3_dml_only": f"""{_ON_LOG}
            SELECT src_partition, src_offset, ev AS event_type FROM routed WHERE NOT is_ddl""",
        "f3b_ddl_log": f"""{_ON_LOG}
            SELECT src_partition, src_offset, db, tab, ev AS event_type, sql_text AS sql, execute_time
            FROM routed WHERE is_ddl""",
        "f4_row_expansion": f"""{_ON_CELLS}
            SELECT src_partition, src_offset, CAST(i - 1 AS INTEGER) AS row_no,
              CASE WHEN ev = 'INSERT' THEN 0 ELSE 7 END AS before_cells,
              CASE WHEN ev = 'DELETE' THEN 0 ELSE 7 END AS after_cells FROM cells_rows""",
        "f5_operation_label": f"""{_ON_LOG}
            SELECT CASE WHEN entry_type = 'ROWDATA' THEN ev ELSE 'NULL' END AS opt,
              count(*) AS envelopes FROM env GROUP BY 1""",
        "f6_insert_image": f"{_ON_IMAGES} SELECT {_CELL_ROW} FROM images WHERE ev = 'INSERT'",
        "f7_delete_image": f"{_ON_IMAGES} SELECT {_CELL_ROW} FROM images WHERE ev = 'DELETE'",
        "f8_update_image_changed": f"{_ON_IMAGES} SELECT {_CELL_ROW} FROM images WHERE ev = 'UPDATE'",
        "f8b_update_image_full": f"""{_with(_LOG, _ROUTED_CELLS, _images(update="full"))}
            SELECT {_CELL_ROW} FROM images WHERE ev = 'UPDATE'""",
        "f9_other_event": f"""{_ON_CELLS}
            SELECT src_partition, src_offset, CAST(i - 1 AS INTEGER) AS row_no, ev AS event_type,
              0 AS src_size, 0 AS cur_size
            FROM cells_rows WHERE ev NOT IN ('INSERT', 'UPDATE', 'DELETE')""",
        "f10_null_as_empty": f"""{_with(_LOG, _ROUTED_CELLS, _images(null="empty"))}
            SELECT {_CELL_ROW} FROM images""",
        "f11_sensitive_columns": f"""{_with(_LOG, _ROUTED_CELLS, _images(), _images(name="plain", sensitive=False))}
            SELECT p.tab, p.side, p.name, unfiltered, coalesce(kept, 0) AS kept
            FROM (SELECT tab, side, name, count(*) AS unfiltered FROM plain GROUP BY ALL) p
            LEFT JOIN (SELECT tab, side, name, count(*) AS kept FROM images GROUP BY ALL) i
              ON p.tab = i.tab AND p.side = i.side AND p.name = i.name""",
        "f12_business_key": f"""{_ON_RECORDS}
            SELECT {_ROW}, topic, key FROM records WHERE key IS NOT NULL""",
        "f13_missing_key": f"""{_ON_RECORDS}
            SELECT {_ROW}, topic, '{TS}' AS key, ev AS opt FROM records WHERE key IS NULL""",
        "f13_quarantine": f"""{_ON_RECORDS}
            SELECT topic, tab, ev AS opt, count(*) AS rows FROM records WHERE key IS NULL GROUP BY ALL""",
        "f14_records": f"""{_ON_RECORDS}
            SELECT {_ROW}, topic, key, mid, db, db AS sch, tab, ev AS opt, CAST({TS} AS BIGINT) AS ts,
              '' AS ddl, '' AS err, src, cur,
              '[dmlts,' || execute_time || '][ip,' || ip || ']' AS cus FROM records""",
        "f14_records_local_form": f"""{_with(_LOG, _records("full", "empty", False))}
            SELECT {_ROW}, topic, coalesce(key, '{TS}') AS key, mid, src, cur FROM records""",
        "f14_records_unfiltered_form": f"""{_with(
                _LOG,
                "unfiltered AS (SELECT env.*, topic, keys, sens FROM env "
                "JOIN routes ON db || '.' || tab = 'shop.' || rtab)",
                _records("full", "empty", False, "unfiltered"))}
            SELECT {_ROW}, topic, coalesce(key, '{TS}') AS key, mid, cur FROM records""",
        "f15_custom_map": f"""{_ON_CELLS}
            SELECT src_partition, src_offset, CAST(i - 1 AS INTEGER) AS row_no,
              CAST(execute_time AS VARCHAR) AS dmlts, ip FROM cells_rows""",
        "f16_envelope_conversion": f"""{_with(_LOG, _ALL_CELLS, _LAST_ROW)}
            SELECT src_partition, src_offset, CAST(0 AS BIGINT) AS mid, db, tab, ev AS opt,
              CAST({TS} AS BIGINT) AS ts, sql_text AS ddl, '' AS err,
              CASE WHEN mapped THEN src_text END AS src, CASE WHEN mapped THEN cur_text END AS cur
            FROM whole""",
        "f17_last_row_per_key": f"""{_with(
                _LOG, _CELLS.format(name="keyed_cells", source="routed", count="n_rows"),
                _NUMBERED.format(source="routed"))},
            found AS (
              SELECT src_partition, src_offset, row_no, any_value(topic) AS topic, any_value(ev) AS ev,
                any_value(sql_text) AS ddl,
                string_agg(coalesce(CASE WHEN ev = 'DELETE' THEN bv ELSE av END, ''), chr(1) ORDER BY idx)
                  FILTER (WHERE is_key AND list_contains(keys, name)
                          AND ev IN ('INSERT', 'UPDATE', 'DELETE')) AS key,
                string_agg('[' || name || ',' || coalesce(bv, '') || ']', '' ORDER BY name)
                  FILTER (WHERE ev = 'DELETE') AS src,
                string_agg('[' || name || ',' || coalesce(CASE WHEN ev = 'DELETE' THEN bv ELSE av END, '')
                  || ']', '' ORDER BY name)
                  FILTER (WHERE ev = 'INSERT' OR (ev = 'DELETE' AND is_key)) AS cur
              FROM keyed_cells GROUP BY ALL),
            last_rows AS (
              SELECT *, row_number() OVER (PARTITION BY src_partition, src_offset, key
                ORDER BY row_no DESC) AS rn FROM found WHERE key IS NOT NULL)
            SELECT src_partition, src_offset, row_no, l.topic, key, first_mid + row_no AS mid,
              l.ev AS opt, ddl,
              CASE WHEN l.ev <> 'UPDATE' THEN coalesce(src, '') END AS src,
              CASE WHEN l.ev <> 'UPDATE' THEN coalesce(cur, '') END AS cur
            FROM last_rows l JOIN numbered USING (src_partition, src_offset) WHERE rn = 1""",
        "f18_end_predicate": f"{_ON_LOG} SELECT src_partition, src_offset, is_end FROM env",
        "f19_envelope_summary": f"""{_with(_LOG, _ALL_CELLS, _FIRST_CELL)}
            SELECT * EXCLUDE (flush_no) FROM summary""",
        "f19_last_of_flush": f"""{_with(_LOG, _ALL_CELLS, _FIRST_CELL)}
            SELECT * FROM summary
            QUALIFY row_number() OVER (PARTITION BY src_partition, flush_no ORDER BY src_offset DESC) = 1""",
        "f20_readable": f"""{_with(_LOG, _ALL_CELLS, _RENDERED)}
            SELECT src_partition, src_offset, entry_type, text FROM readable""",
        "f21_stored_records": f"""{_with(_LOG, _ALL_CELLS, _LAST_ROW)}
            SELECT src_partition,
              100 + row_number() OVER (PARTITION BY src_partition ORDER BY src_offset) - 1 AS entry_row,
              {_WHOLE_HEX} AS value_hex FROM whole""",
        "n1_n2_batch_numbers": f"""{_NO_ROUTES_LOG},
            starts AS (SELECT src_partition AS p, max(batch_id) AS b0, max(in_id) AS i0
              FROM kept GROUP BY 1)
            SELECT src_partition, src_offset, b0 + ends AS out_batch_id,
              place + CASE WHEN ends = 0 THEN i0 ELSE 0 END AS out_in_id
            FROM numbered JOIN starts ON src_partition = p""",
        "n3_record_id": f"""{_ON_RECORDS} SELECT {_ROW}, mid FROM records""",
        "n3_record_id_two_levels": f"""{_with(_LOG, _NUMBERED.format(source="routed"))}
            SELECT src_partition, src_offset, ends AS out_batch_id, place AS out_in_id, first_mid
            FROM numbered""",
        "n4_running_row_key": f"""{_ON_LOG}
            SELECT src_partition, src_offset,
              100 + row_number() OVER (PARTITION BY src_partition ORDER BY src_offset) - 1 AS entry_row
            FROM env""",
        "a1_rows_per_topic": f"""{_ON_LOG}
            SELECT topic, CAST(sum(n_emit) AS BIGINT) AS row_num FROM routed WHERE n_emit > 0 GROUP BY topic""",
        "a2_zero_fill": f"""{_ON_LOG},
            r AS (SELECT batch_id AS flush_no, topic, CAST(sum(n_emit) AS BIGINT) AS row_num
              FROM routed WHERE n_emit > 0 GROUP BY ALL),
            spine AS (SELECT topic, unnest(range(min(flush_no), (SELECT max(flush_no) + 1 FROM r))) AS flush_no
              FROM r GROUP BY topic)
            SELECT flush_no, topic, coalesce(row_num, 0) AS row_num
            FROM spine LEFT JOIN r USING (topic, flush_no)""",
        "a3_topic_delay": f"""{_with(_LOG, _FLUSHED)}
            SELECT flush_no, topic, arg_max({NOW} - execute_time, src_offset) AS delay_ms
            FROM flushed GROUP BY ALL""",
        "a4_batch_delay": f"""{_with(_LOG, _FLUSHED)}
            SELECT flush_no, arg_max({NOW} - execute_time, src_offset) AS batch_delay_ms
            FROM flushed GROUP BY ALL""",
        "a5_reported_delay": f"""{_with(_LOG, _FLUSHED, _REPORTED)} SELECT * FROM reported""",
        "a6_send_stats": f"""{_ON_RECORDS}
            SELECT topic, count(*) AS send_num, CAST(sum({_RECORD_SIZE}) AS BIGINT) AS send_size
            FROM records WHERE key IS NOT NULL GROUP BY topic""",
        "a7_fetch_per_minute": f"""{_with(_FETCHED)}
            SELECT src_partition, strftime(minute, '%Y-%m-%d %H:%M') AS minute, count(*) AS fetch_num,
              CAST(sum(n_bytes) AS BIGINT) AS fetch_size FROM fetched GROUP BY ALL""",
        "a8_offset_lag": f"""{_with(_FETCHED)},
            m AS (SELECT src_partition, minute, max(next_offset) AS now_,
                arg_max(latest_offset, next_offset) AS latest FROM fetched GROUP BY ALL),
            spine AS (SELECT src_partition, unnest(generate_series(min(minute), max(minute),
                INTERVAL 1 MINUTE)) AS minute FROM m GROUP BY src_partition),
            filled AS (
              SELECT src_partition, minute,
                last_value(now_ IGNORE NULLS) OVER so_far AS now_,
                last_value(latest IGNORE NULLS) OVER so_far AS latest
              FROM spine LEFT JOIN m USING (src_partition, minute)
              WINDOW so_far AS (PARTITION BY src_partition ORDER BY minute
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
            shown AS (SELECT *, CASE WHEN now_ <= 0 OR now_ > latest THEN latest ELSE now_ END AS s
              FROM filled)
            SELECT src_partition, strftime(minute, '%Y-%m-%d %H:%M') AS minute, s AS now_offset,
              latest AS last_offset, latest - s AS delay_num FROM shown""",
        "a9_fetch_totals": f"""{_with(_FETCHED)},
            runs AS (SELECT *, (row_number() OVER (PARTITION BY src_partition ORDER BY next_offset) - 1)
              // 501 AS run_no FROM fetched)
            SELECT src_partition, run_no, count(*) AS fetch_num, CAST(sum(n_bytes) AS BIGINT) AS fetch_size,
              date_sub('millisecond', min(fetch_ts), max(fetch_ts)) AS elapsed_ms,
              count(*) = 501 AS complete FROM runs GROUP BY ALL""",
        "a10_monitor_records": f"""{_with(_LOG, _FLUSHED, _REPORTED)},
            r AS (SELECT flush_no, topic, CAST(sum(n_emit) AS BIGINT) AS row_num
              FROM flushed WHERE n_emit > 0 GROUP BY ALL)
            SELECT flush_no, 31102 AS id, 'job_1' AS jrdw_mark, {_topic_json('topic', 'row_num')} AS content
            FROM r GROUP BY flush_no
            UNION ALL
            SELECT flush_no, 31104, 'job_1', {_topic_json('topic', 'reported_delay_ms')}
            FROM reported GROUP BY flush_no""",
        "a10b_older_monitor_records": f"""{_with(_FETCHED)},
            m AS (SELECT src_partition, strftime(minute, '%Y-%m-%d %H:%M') AS minute,
              count(*) AS n, CAST(sum(n_bytes) AS BIGINT) AS size FROM fetched GROUP BY ALL)
            SELECT src_partition, minute, 22000 AS id, 'job_1' AS jrdw_mark,
              '{{"FETCH_NUM":' || n || ',"FETCH_SIZE":' || size || '}}' AS content FROM m
            UNION ALL SELECT src_partition, minute, 0, 'job_1', '{{}}' FROM m""",
        "a11_exception_and_host_records": f"""{_ON_RECORDS}
            SELECT 22003 AS id, 'job_1' AS jrdw_mark,
              '{{"EXCEPTION":"no key: ' || tab || '@' || src_offset || '/' || row_no || '"}}' AS content
            FROM records WHERE key IS NULL
            UNION ALL
            SELECT DISTINCT 22004, 'job_1', '{{"IP":"' || ip || '"}}' FROM env""",
        "r1_record_key": f"""{_with(_LOG, _records())},
            parts AS (
              SELECT src_partition, src_offset, row_no,
                max(coalesce(value, 'null') || '#') FILTER (WHERE name = 'product_id') AS p,
                max(coalesce(value, 'null') || '#') FILTER (WHERE name = 'return_flag') AS f,
                max(coalesce(value, 'null') || '#') FILTER (WHERE name = 'order_key') AS o
              FROM images WHERE side = 'cur' GROUP BY ALL)
            SELECT {_ROW}, db || '#' || tab || '#' || coalesce(p, '') || coalesce(f, '') ||
              coalesce(o, '') || ev AS change_key
            FROM records LEFT JOIN parts USING (src_partition, src_offset, row_no)""",
        "r2_json_key": f"{_ON_RECORDS} SELECT {_ROW}, {_BOTH_KEYS} AS change_key FROM records",
        "r3_missing_changes": f"""{_ON_RECORDS}
            SELECT {_BOTH_KEYS} AS change_key FROM records
            EXCEPT SELECT {_BOTH_KEYS} FROM records WHERE {_DELIVERED}""",
        "r3_missing_count": f"""{_ON_RECORDS}
            SELECT count(*) AS missing FROM (SELECT {_BOTH_KEYS} AS change_key FROM records
              EXCEPT SELECT {_BOTH_KEYS} FROM records WHERE {_DELIVERED})""",
        "r4_capture_counts": f"""{_ON_RECORDS}
            SELECT 'json' AS feed, count(*) AS messages FROM records
            WHERE execute_time >= 820454400000 AND execute_time < 820454400000 + 3 * 31536000000
            UNION ALL
            SELECT 'record', count(*) FROM records WHERE {_DELIVERED}
              AND execute_time >= 820454400000 AND execute_time < 820454400000 + 3 * 31536000000""",
        "r5_table_probe": f"""{_ON_CELLS}
            SELECT src_partition, src_offset, CAST(i - 1 AS INTEGER) AS row_no, db, tab
            FROM cells_rows WHERE contains(tab, '_2')""",
        "r6_listed_columns": f"""{_with(_LOG, _ALL_CELLS)}
            SELECT {_ROW}, db, tab, name, coalesce(CASE WHEN ev = 'DELETE' THEN bv ELSE av END, '') AS value
            FROM all_cells WHERE NOT is_ddl AND name IN ('product_id', 'created')""",
        "r6_watched_cells": f"""{_with(_LOG, _ALL_CELLS)}
            SELECT {_ROW}, db, tab, name, CASE WHEN ev = 'DELETE' THEN bv ELSE av END AS value
            FROM all_cells WHERE NOT is_ddl AND name = 'product_id' AND
              c IN (SELECT p_partkey FROM part WHERE p_size > 40)""",
        "r7_watched_values": f"""{_ON_IMAGES}
            SELECT {_ROW}, db, tab, name, value FROM images
            WHERE side = 'cur' AND name = 'product_id' AND
              c IN (SELECT p_partkey FROM part WHERE p_size > 40)""",
        "r8_null_audit": f"""{_ON_IMAGES}
            SELECT db, tab, side, name, count(*) AS "values",
              count(*) FILTER (WHERE value IS NULL) AS null_values,
              count(*) FILTER (WHERE value = '') AS empty_values FROM images GROUP BY ALL""",
        "r9_map_dump": f"""{_ON_RECORDS}
            SELECT {_ROW}, src, cur, '[dmlts,' || execute_time || '][ip,' || ip || ']' AS cus FROM records""",
        "r10_topic_dump": f"""{_ON_RECORDS}
            SELECT db, tab, ev AS opt, '' AS ddl,
              '[dmlts,' || execute_time || '][ip,' || ip || ']' AS cus, cur FROM records""",
        "r11_routed_tables": f"""{_with(_CONFIGS)}
            SELECT DISTINCT dbname || '.' || tablename AS db_tab FROM entries""",
        "r12_sensitive_configs": f"""{_with(_CONFIGS)}
            SELECT job, '{{"data":{{"db_tab_meta":[' || string_agg('{{"dbname":"' || dbname ||
              '","tablename":"' || tablename || '","sensefield":"customerName,address,phone,usermob,' ||
              'email,remark,userremark,orderftel,premark"}}', ',' ORDER BY pos) || ']}}}}' AS config
            FROM entries GROUP BY job""",
        "k1_keyed_messages": f"""{_ON_RECORDS}
            SELECT topic, key, {_RECORD_HEX} AS value_hex FROM records WHERE key IS NOT NULL""",
        "k2_stored_entries": f"""{_with(_LOG, _ALL_CELLS, _RENDERED)}
            SELECT src_partition,
              row_number() OVER (PARTITION BY src_partition ORDER BY src_offset) - 1 AS entry_row,
              coalesce(text, '') AS value FROM readable""",
        "k3_positions": f"""{_with(_LOG, _NUMBERED.format(source="routed"))},
            seen AS (SELECT src_partition, max(src_offset) + 1 AS next_offset, max(seq) AS seq
              FROM env GROUP BY 1),
            final AS (SELECT src_partition,
                arg_max(ends + CASE WHEN is_end THEN 1 ELSE 0 END, src_offset) AS b,
                arg_max(CASE WHEN is_end THEN 0 ELSE place + 1 END, src_offset) AS i,
                arg_max(first_mid + n_emit, src_offset) AS u FROM numbered GROUP BY 1)
            SELECT src_partition, seq // 100 AS last_batch_id, seq % 100 AS last_in_id,
              'changes:' || src_partition || ':' || next_offset || ':' || b || ':' || i || ':' || u AS position
            FROM seen JOIN final USING (src_partition)""",
        "k4_position_history": f"""{_ON_LOG},
            p AS (SELECT 'job_' || (src_offset % 3) AS job, src_offset AS epoch, src_partition,
                'changes:' || src_partition || ':' || (src_offset + 1) || ':' || batch_id || ':' || in_id AS text,
                make_timestamp((execute_time // 60000) * 60000000) AS minute FROM env)
            SELECT job, 'changes' AS src_topic, src_partition, strftime(minute, '%Y-%m-%d') AS date,
              strftime(minute, '%H') AS hour, strftime(minute, '%H:%M') AS time,
              arg_max(text, epoch) AS position FROM p GROUP BY job, src_partition, minute""",
        "k5_monitor_messages": f"""{_ON_LOG},
            r AS (SELECT topic, CAST(sum(n_emit) AS BIGINT) AS row_num
              FROM routed WHERE n_emit > 0 GROUP BY topic),
            m AS (SELECT {_topic_json('topic', 'row_num')} AS content FROM r)
            SELECT '{{"id":31102,"jrdw_mark":"job_1","content":' ||
              CAST(to_json(content) AS VARCHAR) || '}}' AS value FROM m""",
        "p1_key_partitions": f"""{_ON_RECORDS}
, p31s AS ({_POWERS}),
            keys_ AS (SELECT key, count(*) AS messages FROM records WHERE key IS NOT NULL GROUP BY key),
            units AS (SELECT key, messages, unnest(range(0, length(key))) AS place_ FROM keys_),
            hashed AS (SELECT key, messages, list_sum(list(CAST(unicode(substr(key, CAST(place_ + 1 AS BIGINT), 1)) AS HUGEINT)
                * CAST(p31 AS HUGEINT))) % 4294967296 AS h
              FROM units JOIN p31s ON e = length(key) - 1 - place_ GROUP BY key, messages)
            SELECT key, messages, CAST((CASE WHEN h = 2147483648 THEN 0 WHEN h > 2147483648 THEN 4294967296 - h
              ELSE h END) % 16 AS INTEGER) AS partition FROM hashed""",
        "p2_suffix_partitions": """
            SELECT CAST(CASE WHEN o_orderkey % 5 > 1 THEN o_orderkey % 12 ELSE 0 END AS INTEGER) AS partition,
              count(*) AS messages FROM orders GROUP BY 1""",
    }
    sql |= {
        "s1_live_tail": """
            WITH m AS (SELECT CAST(event_id % 4 AS INTEGER) AS src_partition, event_id // 4 AS src_offset, props AS value FROM events),
            kept AS (SELECT *, max(src_offset) OVER (PARTITION BY src_partition) + 1 AS latest_offset FROM m
              WHERE src_partition != 0 OR src_offset >= 50)
            SELECT src_partition, src_offset, latest_offset, value FROM kept
            WHERE src_partition IN (0, 3) OR src_partition = 1 AND src_offset >= 150""",
        "a9_live_totals": """
            SELECT count(*) AS fetch_num, CAST(sum(strlen(props)) AS BIGINT) AS fetch_size, CAST(0 AS BIGINT) AS delay_num FROM events""",
        "k3_committed_epochs": """
            SELECT event_id, event_type AS topic, event_id // 1024 AS epoch FROM events
            WHERE event_id // 1024 < 10 OR event_id // 1024 % 2 = 0""",
        "s5_zone_scan": """
            WITH e AS (SELECT event_id AS event_row, CASE WHEN event_id % 997 = 500 THEN NULL
                WHEN event_id % 499 = 3 THEN '' ELSE props END AS event_text FROM events),
            starts AS (SELECT unnest([100, 501, 1498]) AS start),
            stops AS (SELECT start, coalesce(min(event_row) FILTER (WHERE event_text IS NULL AND event_row >= start
                AND event_row < start + 1000), start + 1000) AS stop FROM e, starts GROUP BY start)
            SELECT start, event_row, event_text FROM e, stops WHERE event_row >= start AND event_row < stop""",
        "r3_digest_differences": f"""{_ON_RECORDS},
            json_side AS (SELECT DISTINCT {_BOTH_KEYS} AS change_key FROM records WHERE (src_offset // 2) % 53 <> 5),
            record_side AS (SELECT DISTINCT {_BOTH_KEYS} AS change_key FROM records WHERE {_DELIVERED})
            SELECT change_key, 'right' AS missing_in FROM (FROM json_side EXCEPT FROM record_side)
            UNION ALL SELECT change_key, 'left' FROM (FROM record_side EXCEPT FROM json_side)""",
        "a7_live_minutes": f"""{_with(_FETCHED)},
            batches AS (SELECT *, least(3, (next_offset - 1) * 4 // (SELECT max(event_id) + 1 FROM events)
                + CASE WHEN (next_offset - 1) % 10 = 3 THEN 1 ELSE 0 END) AS batch FROM fetched),
            tops AS (SELECT src_partition, batch, max(fetch_ts) AS top FROM batches GROUP BY ALL),
            marks AS (SELECT src_partition, batch, max(top) OVER (PARTITION BY src_partition ORDER BY batch
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM tops)
            SELECT src_partition, strftime(minute, '%Y-%m-%d %H:%M') AS minute, count(*) AS fetch_num,
              CAST(sum(n_bytes) AS BIGINT) AS fetch_size,
              count(*) FILTER (WHERE minute + INTERVAL 11 MINUTE <= newest) AS late_num
            FROM batches JOIN marks USING (src_partition, batch) GROUP BY src_partition, minute""",
        "f2_routes_as_of": f"""{_ON_LOG},
            ends AS (SELECT src_partition, max(src_offset) AS last FROM env GROUP BY 1),
            at_ AS (SELECT src_partition, src_offset, tab, CASE WHEN src_partition < 2 AND src_offset >= last * 3 // 4 THEN 2
                WHEN src_offset >= last // 2 THEN 1 ELSE 0 END AS version
              FROM kept JOIN ends USING (src_partition) WHERE db = 'shop'),
            versions(version, tab, topic) AS (VALUES (0, 'orders_0', 'mysql_a'), (0, 'orders_1', 'mysql_a'),
              (0, 'orders_2', 'mysql_b'), (0, 'orders_3', 'mysql_c'), (1, 'orders_0', 'mysql_z'),
              (1, 'orders_4', 'mysql_b'), (2, 'orders_1', 'mysql_a'), (2, 'orders_5', 'mysql_z'))
            SELECT src_partition, src_offset, topic FROM at_ JOIN versions USING (version, tab)""",
        "p1_placed_messages": f"SELECT partition AS task, key, messages FROM ({sql['p1_key_partitions']})",
    }
    return sql
