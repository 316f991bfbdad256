"""Fixed schemas of envelopes, records and the tables around them."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the enum members in the wire format.
ENTRY_TYPES = ("TRANSACTIONBEGIN", "ROWDATA", "TRANSACTIONEND", "HEARTBEAT")
EVENT_TYPES = (
    "INSERT", "UPDATE", "DELETE", "CREATE", "ALTER", "ERASE",
    "QUERY", "TRUNCATE", "RENAME", "CINDEX", "DINDEX",
)
SOURCE_TYPES = ("ORACLE", "MYSQL", "PGSQL")

_STRING, _BIGINT, _INT, _BOOLEAN = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
TEXT_MAP = T.MapType(_STRING, _STRING)
TEXT_LIST = T.ArrayType(_STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CELL = _struct(
    idx=_INT, sql_type=_INT, name=_STRING, is_key=_BOOLEAN, updated=_BOOLEAN, is_null=_BOOLEAN,
    value=_STRING, length=_INT, mysql_type=_STRING,
)
CELLS = T.ArrayType(CELL)
HEADER = _struct(
    version=_INT, logfile_name=_STRING, logfile_offset=_BIGINT, server_id=_BIGINT,
    server_encode=_STRING, execute_time=_BIGINT, source_type=_STRING, schema_name=_STRING,
    table_name=_STRING, event_length=_BIGINT, event_type=_STRING, props=TEXT_MAP,
)
ROW_CHANGE = _struct(
    table_id=_BIGINT, event_type=_STRING, is_ddl=_BOOLEAN, sql=_STRING, ddl_schema_name=_STRING,
    row_datas=T.ArrayType(_struct(before=CELLS, after=CELLS)), props=TEXT_MAP,
)
TX_BEGIN = _struct(
    execute_time=_BIGINT, transaction_id=_STRING, thread_id=_BIGINT, props=TEXT_MAP
)
TX_END = _struct(execute_time=_BIGINT, transaction_id=_STRING, props=TEXT_MAP)

# What a decoder yields from one message; the source columns are added by the reader.
ENVELOPE_BODY = _struct(
    entry_type=_STRING, batch_id=_BIGINT, in_id=_BIGINT, ip=_STRING, header=HEADER,
    row_change=ROW_CHANGE, tx_begin=TX_BEGIN, tx_end=TX_END,
)
ENVELOPE = T.StructType(
    _struct(src_topic=_STRING, src_partition=_INT, src_offset=_BIGINT).fields
    + ENVELOPE_BODY.fields
)

# In the published schema the first six fields are never null.
RECORD_BODY = _struct(
    mid=_BIGINT, db=_STRING, sch=_STRING, tab=_STRING, opt=_STRING, ts=_BIGINT, ddl=_STRING,
    err=_STRING, src=TEXT_MAP, cur=TEXT_MAP, cus=TEXT_MAP,
)
RECORD_FIELDS = tuple(RECORD_BODY.fieldNames())

POSITIONS = _struct(
    job=_STRING, step=_BIGINT, src_topic=_STRING, src_partition=_INT, next_offset=_BIGINT,
    last_batch_id=_BIGINT, last_in_id=_BIGINT, batch_id=_BIGINT, in_id=_BIGINT, mid=_BIGINT,
    sent=_BIGINT, written_at=_BIGINT,
)
MONITOR = _struct(id=_INT, jrdw_mark=_STRING, content=_STRING)
JSON_CHANGE = _struct(schema=_STRING, table=_STRING, operation=_STRING, fields=TEXT_MAP)
