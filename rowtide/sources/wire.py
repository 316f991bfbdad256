"""Tables of message bytes to typed rows and back.

Decoding is a narrow step: Spark hands each task Arrow batches of messages. A message that does
not decode keeps its source columns, has null fields and the reason in ``decode_error``. Envelopes
are converted field by field over a batch; the row functions here are for those that are not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.functions.arrow_rows import to_column, to_rows
from rowtide.functions.avro_bytes import record_bytes
from rowtide.functions.record_codec import RECORD_AVRO_SCHEMA, decode_record
from rowtide.schemas import ENVELOPE_BODY, RECORD_BODY, RECORD_FIELDS
from rowtide.sources import envelope_columns
from rowtide.sources.envelope_columns import CELL, HEADER

DECODE_ERROR = "decode_error"
# Of a batch, converted at once.
_PART_BYTES = 4_000_000


def decode_envelopes(messages: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Decode envelope bytes, then the nested bytes by entry type.

    Unset fields read as their defaults: UPDATE, ROWDATA, 0, empty text. ``strict`` fails the
    job on bytes that do not decode.
    """
    return _decoded(messages, value, ENVELOPE_BODY, _envelope_of, strict, envelope_columns.decode)


def decode_records(messages: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Decode record bytes."""
    if _has_jvm_class(messages, "org.apache.spark.sql.avro.AvroDataToCatalyst"):
        from pyspark.sql.avro.functions import from_avro

        mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
        record = from_avro(F.col(value), RECORD_AVRO_SCHEMA, mode)
        return messages.withColumn("_record", record).select(
            *[c for c in messages.columns if c != value],
            *[F.col(f"_record.{name}").alias(name) for name in RECORD_FIELDS],
            F.when(F.col("_record.db").isNull(), F.lit("bytes do not decode")).alias(DECODE_ERROR),
        )
    return _decoded(messages, value, RECORD_BODY, decode_record, strict)


def encode_records(records: DataFrame) -> DataFrame:
    """Replace the record columns by ``value``, the record's bytes; other columns stay."""
    if _has_jvm_class(records, "org.apache.spark.sql.avro.CatalystDataToAvro"):
        from pyspark.sql.avro.functions import to_avro

        rest = [c for c in records.columns if c not in RECORD_FIELDS]
        return records.select(
            *rest, to_avro(F.struct(*RECORD_FIELDS), RECORD_AVRO_SCHEMA).alias("value")
        )
    rest = [c for c in records.columns if c not in RECORD_FIELDS]
    return records.select(*rest, record_bytes().alias("value"))


def encode_envelopes(envelopes: DataFrame) -> DataFrame:
    """Replace the envelope columns by ``value``, the message bytes; source columns stay."""
    return _encoded(envelopes, ENVELOPE_BODY.names, _envelope_bytes, envelope_columns.encode)


def decoded_ok(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(DECODE_ERROR).isNull()).drop(DECODE_ERROR)


def undecodable(decoded: DataFrame) -> DataFrame:
    """Messages for the quarantine table: where they are and why."""
    source = [c for c in ("src_topic", "src_partition", "src_offset") if c in decoded.columns]
    return decoded.where(F.col(DECODE_ERROR).isNotNull()).select(*source, DECODE_ERROR)


def _has_jvm_class(df: DataFrame, name: str) -> bool:
    try:
        df.sparkSession._jvm.java.lang.Class.forName(name)
        return True
    except Exception:  # py4j wraps ClassNotFoundException
        return False


def _decoded(
    messages: DataFrame,
    value: str,
    body: T.StructType,
    decode: Callable[[bytes], dict],
    strict: bool,
    decode_batch: Callable[[pa.Array], tuple[list[pa.Array], np.ndarray]] | None = None,
) -> DataFrame:
    """``decode_batch`` gives the columns and the rows that ``decode`` has to read instead."""
    kept = [c for c in messages.columns if c != value]
    body_arrow = to_arrow_schema(body)
    schema = T.StructType(
        [messages.schema[c] for c in kept]
        + list(body.fields)
        + [T.StructField(DECODE_ERROR, T.StringType())]
    )

    def by_row(values: pa.Array) -> list[pa.Array]:
        rows, errors = [], []
        for data in values.to_pylist():
            try:
                rows.append(decode(data if data is not None else b""))
                errors.append(None)
            except Exception as error:
                if strict:
                    raise
                rows.append({})
                errors.append(f"{type(error).__name__}: {error}")
        columns = [to_column([row.get(f.name) for row in rows], f.type) for f in body_arrow]
        return [*columns, pa.array(errors, pa.string())]

    def together(values: pa.Array) -> list[pa.Array]:
        if decode_batch is None or not pa.types.is_binary(values.type):
            return by_row(values)
        columns, odd = decode_batch(values)
        columns = [*columns, pa.nulls(len(values), pa.string())]
        if odd.any():
            place = np.arange(len(values))
            place[odd] = len(values) + np.arange(odd.sum())
            rest = by_row(values.filter(pa.array(odd)))
            columns = [pa.concat_arrays(pair).take(pa.array(place)) for pair in zip(columns, rest, strict=True)]
        return columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                columns = [part.column(c) for c in kept] + together(part.column(value))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return messages.select(*kept, value).mapInArrow(run, schema)


def _encoded(
    df: DataFrame,
    fields,
    encode: Callable[[dict], bytes],
    encode_batch: Callable[[dict[str, pa.Array]], pa.Array],
) -> DataFrame:
    """``encode`` writes the rows of a batch that ``encode_batch`` does not."""
    fields = list(fields)
    kept = [c for c in df.columns if c not in fields]
    schema = T.StructType(
        [df.schema[c] for c in kept] + [T.StructField("value", T.BinaryType())]
    )

    def together(columns: dict[str, pa.Array]) -> pa.Array:
        try:
            return encode_batch(columns)
        except pa.ArrowException:
            rows = zip(*map(to_rows, columns.values()), strict=True)
            return pa.array([encode(dict(zip(fields, row, strict=True))) for row in rows], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                values = together({c: part.column(c) for c in fields})
                columns = [part.column(c) for c in kept] + [values]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*kept, *fields).mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in even parts of so many bytes at most, which bounds what a part's numbers take."""
    rows = max(1, batch.num_rows // -(-max(1, batch.nbytes) // _PART_BYTES))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _enum_name(message, field: str) -> str:
    descriptor = message.DESCRIPTOR.fields_by_name[field].enum_type
    return descriptor.values_by_number[getattr(message, field)].name


def _pairs(message) -> list[tuple[str, str]]:
    return list({p.key: p.value for p in message.props}.items())


def _parse(name: str, data: bytes):
    from rowtide.sources.messages import message_class

    message = message_class(name)()
    message.ParseFromString(data)
    return message


_CELL_VALUES = attrgetter(*CELL.values())


def _cells_of(columns) -> list[dict]:
    return [dict(zip(CELL, _CELL_VALUES(column))) for column in columns]


def _envelope_of(data: bytes) -> dict:
    entry = _parse("Entry", data)
    kind = _enum_name(entry, "entryType")
    header = {k: getattr(entry.header, f) for k, f in HEADER.items()}
    header["source_type"] = _enum_name(entry.header, "sourceType")
    header["event_type"] = _enum_name(entry.header, "eventType")
    header["props"] = _pairs(entry.header)
    envelope = {
        "entry_type": kind,
        "batch_id": entry.batchId,
        "in_id": entry.inId,
        "ip": entry.ip,
        "header": header,
    }
    if kind == "ROWDATA":
        change = _parse("RowChange", entry.storeValue)
        envelope["row_change"] = {
            "table_id": change.tableId,
            "event_type": _enum_name(change, "eventType"),
            "is_ddl": change.isDdl,
            "sql": change.sql,
            "ddl_schema_name": change.ddlSchemaName,
            "row_datas": [
                {"before": _cells_of(r.beforeColumns), "after": _cells_of(r.afterColumns)}
                for r in change.rowDatas
            ],
            "props": _pairs(change),
        }
    elif kind == "TRANSACTIONBEGIN":
        begin = _parse("TransactionBegin", entry.storeValue)
        envelope["tx_begin"] = {
            "execute_time": begin.executeTime,
            "transaction_id": begin.transactionId,
            "thread_id": begin.threadId,
            "props": _pairs(begin),
        }
    elif kind == "TRANSACTIONEND":
        end = _parse("TransactionEnd", entry.storeValue)
        envelope["tx_end"] = {
            "execute_time": end.executeTime,
            "transaction_id": end.transactionId,
            "props": _pairs(end),
        }
    return envelope


def _fill(message, values: dict, fields: dict) -> None:
    for name, field in fields.items():
        if values[name] is not None:
            setattr(message, field, values[name])


def _put_enum(message, field: str, name: str | None) -> None:
    if name is not None:
        enum = message.DESCRIPTOR.fields_by_name[field].enum_type
        setattr(message, field, enum.values_by_name[name].number)


def _put_pairs(message, pairs) -> None:
    for key, value in pairs or []:
        message.props.add(key=key, value=value)


def _envelope_bytes(row: dict) -> bytes:
    from rowtide.sources.messages import message_class

    entry = message_class("Entry")()
    _put_enum(entry, "entryType", row["entry_type"])
    _fill(entry, row, {"batch_id": "batchId", "in_id": "inId", "ip": "ip"})
    if row["header"] is not None:
        _fill(entry.header, row["header"], HEADER)
        _put_enum(entry.header, "sourceType", row["header"]["source_type"])
        _put_enum(entry.header, "eventType", row["header"]["event_type"])
        _put_pairs(entry.header, row["header"]["props"])
    kind = row["entry_type"] or "ROWDATA"
    if kind == "ROWDATA" and row["row_change"] is not None:
        change = message_class("RowChange")()
        values = row["row_change"]
        _put_enum(change, "eventType", values["event_type"])
        _fill(
            change,
            values,
            {"table_id": "tableId", "is_ddl": "isDdl", "sql": "sql",
             "ddl_schema_name": "ddlSchemaName"},
        )
        _put_pairs(change, values["props"])
        for row_data in values["row_datas"] or []:
            added = change.rowDatas.add()
            for side, columns in (("before", added.beforeColumns), ("after", added.afterColumns)):
                for cell in row_data[side] or []:
                    columns.add(**{field: cell[k] for k, field in CELL.items() if cell[k] is not None})
        entry.storeValue = change.SerializeToString()
    elif kind == "TRANSACTIONBEGIN" and row["tx_begin"] is not None:
        begin = message_class("TransactionBegin")()
        _fill(begin, row["tx_begin"], {"execute_time": "executeTime",
                                       "transaction_id": "transactionId", "thread_id": "threadId"})
        entry.storeValue = begin.SerializeToString()
    elif kind == "TRANSACTIONEND" and row["tx_end"] is not None:
        end = message_class("TransactionEnd")()
        _fill(end, row["tx_end"], {"execute_time": "executeTime",
                                   "transaction_id": "transactionId"})
        entry.storeValue = end.SerializeToString()
    return entry.SerializeToString()
