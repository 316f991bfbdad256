"""Envelope bytes of a whole Arrow batch to columns and back: field by field, not message by message.

Writers put fields in the order of their numbers, so all messages of a batch are read in step: each
field in turn is taken from those that have it next. Messages that are not laid out that way, have
fields that no column holds, or do not decode are told to the caller, who reads them one by one.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.schemas import ENVELOPE_BODY
from rowtide.sources.messages import enum_names, layout

# Typed column name -> message field, for the parts that map one to one.
HEADER = {
    "version": "version", "logfile_name": "logfileName", "logfile_offset": "logfileOffset",
    "server_id": "serverId", "server_encode": "serverenCode", "execute_time": "executeTime",
    "schema_name": "schemaName", "table_name": "tableName", "event_length": "eventLength",
}
CELL = {
    "idx": "index", "sql_type": "sqlType", "name": "name", "is_key": "isKey",
    "updated": "updated", "is_null": "isNull", "value": "value", "length": "length",
    "mysql_type": "mysqlType",
}
# The same with enums and lists; fields that columns are made of by hand are left out.
_COLUMNS = {
    "Entry": {"entry_type": "entryType", "batch_id": "batchId", "in_id": "inId", "ip": "ip"},
    "Header": HEADER | {"source_type": "sourceType", "event_type": "eventType", "props": "props"},
    "Column": CELL,
    "RowData": {"before": "beforeColumns", "after": "afterColumns"},
    "RowChange": {
        "table_id": "tableId", "event_type": "eventType", "is_ddl": "isDdl", "sql": "sql",
        "ddl_schema_name": "ddlSchemaName", "row_datas": "rowDatas", "props": "props",
    },
    "TransactionBegin": {
        "execute_time": "executeTime", "transaction_id": "transactionId",
        "thread_id": "threadId", "props": "props",
    },
    "TransactionEnd": {
        "execute_time": "executeTime", "transaction_id": "transactionId", "props": "props",
    },
    "Pair": {"key": "key", "value": "value"},
}
# What the stored value of an entry is, by entry type.
_STORED = {
    "ROWDATA": ("row_change", "RowChange"),
    "TRANSACTIONBEGIN": ("tx_begin", "TransactionBegin"),
    "TRANSACTIONEND": ("tx_end", "TransactionEnd"),
}
# Read, but not written.
_READ_ONLY = {("TransactionBegin", "props"), ("TransactionEnd", "props")}
_TYPES = {field.name: field.type for field in to_arrow_schema(ENVELOPE_BODY)}
_VARINT, _SPAN = 0, 2
# Fewer messages than this are read on one by one.
_FEW = 16
_NOTHING = pa.scalar(b"", pa.binary())


# --- bytes to columns ------------------------------------------------------------------------


def decode(messages: pa.Array) -> tuple[list[pa.Array], np.ndarray]:
    """Columns of the envelope body, and which messages have to be decoded one by one instead."""
    data, begin, end = _bytes_of(messages)
    entry = _Fields("Entry", data, begin, end)
    kinds = entry.columns["entry_type"]
    header = _Fields("Header", data, *entry.spans["header"])
    begin, end = entry.spans["storeValue"]
    odd = entry.odd | header.odd
    columns = [*(entry.columns[c] for c in ("entry_type", "batch_id", "in_id", "ip")), header.struct(_TYPES["header"])]
    for kind, (column, name) in _STORED.items():
        here = pc.equal(kinds, kind).to_numpy(zero_copy_only=False)
        stored = _Fields(name, data, begin, np.where(here, end, begin))
        odd |= stored.odd
        columns.append(stored.struct(_TYPES[column], ~here))
    return columns, odd


def _bytes_of(messages: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all messages, where each begins and where it ends; a null message is empty."""
    _, offsets, data = messages.buffers()
    places = np.frombuffer(offsets, np.int32)[messages.offset :][: len(messages) + 1] if len(messages) else np.zeros(1, np.int32)
    low, high = int(places[0]), int(places[-1])
    # Numbers are read by words of eight bytes, the last of them too.
    own = np.zeros(high - low + 16, np.uint8)
    if high > low:
        own[: high - low] = np.frombuffer(data, np.uint8)[low:high]
    places = places.astype(np.int64) - low
    begin, end = places[:-1], places[1:]
    if messages.null_count:
        end = np.where(messages.is_valid().to_numpy(zero_copy_only=False), end, begin)
    return own, begin, end


class _Fields:
    """The fields of messages of one kind; ``odd`` are those that could not be read to their end."""

    def __init__(self, name: str, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.data, self.at, self.end = data, begin.copy(), end
        self.columns: dict[str, pa.Array] = {}
        self.spans: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.odd = np.zeros(len(begin), bool)
        column_of = {label: column for column, label in _COLUMNS[name].items()}
        for number, label, kind, default in layout(name):
            if kind.startswith("*"):
                # Those without a column are read too, which tells whether they decode.
                self.columns[column_of.get(label, label)] = self._repeated(number, kind[1:])
            elif kind in ("string", "bytes", "Header"):
                self.spans[label] = self._span(number)
                if kind == "string":
                    self.columns[column_of[label]] = self._texts(*self.spans[label])
            else:
                self.columns[column_of[label]] = self._numbers(number, kind, default)
        # A message stays where it could not be read, which no later field fits.
        self.odd |= self.at != self.end

    def struct(self, kind: pa.StructType, mask: np.ndarray | None = None) -> pa.Array:
        """The fields as one column, null where the mask is set."""
        fields = [_as(self.columns[field.name], field.type) for field in kind]
        return pa.StructArray.from_arrays(fields, fields=list(kind), mask=None if mask is None else pa.array(mask))

    def _next(self, number: int, wire: int) -> np.ndarray:
        """Rows that have this field next."""
        return np.flatnonzero((self.data[self.at] == (number << 3 | wire)) & (self.at < self.end))

    def _varints(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number behind the tag in these rows, where it ends and whether it is one."""
        begin = self.at[rows] + 1
        first = self.data[begin]
        value, size = first.astype(np.int64), np.ones(len(rows), np.int64)
        long = np.flatnonzero(first >= 0x80)
        if len(long):
            value[long], size[long] = _long_varints(self.data, begin[long])
        after = begin + size
        return value, after, (size > 0) & (after <= self.end[rows])

    def _numbers(self, number: int, kind: str, default) -> pa.Array:
        names = enum_names(kind)
        rows = self._next(number, _VARINT)
        value, after, fits = self._varints(rows)
        if kind != "int64":
            least, most = (1, len(names)) if names else (0, 1) if kind == "bool" else (-(2**31), 2**31 - 1)
            fits &= (value >= least) & (value <= most)
        if not fits.all():
            rows, value, after = rows[fits], value[fits], after[fits]
        given = value
        if len(rows) != len(self.at):
            given = np.full(len(self.at), default, np.int64)
            given[rows] = value
        self.at[rows] = after
        if names:
            return pa.array(names, pa.string()).take(pa.array(given - 1))
        return pa.array(given.astype({"bool": bool, "int32": np.int32, "int64": np.int64}[kind]))

    def _lengths(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of these rows those whose next field fits in, where its bytes begin and end."""
        size, begin, fits = self._varints(rows)
        fits &= (size >= 0) & (size <= self.end[rows] - begin)
        if not fits.all():
            rows, size, begin = rows[fits], size[fits], begin[fits]
        return rows, begin, begin + size

    def _span(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the bytes of the field begin and end; nowhere if it is not there."""
        rows, begin, end = self._lengths(self._next(number, _SPAN))
        begins = self.at.copy()
        self.at[rows], begins[rows] = end, begin
        return begins, self.at.copy()

    def _texts(self, begin: np.ndarray, end: np.ndarray) -> pa.Array:
        """The bytes between these places as texts; rows where they are none are odd."""
        texts = _cut(self.data, begin, end)
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            good = np.array([_is_text(text) for text in texts.view(pa.binary()).to_pylist()], bool)
            self.odd |= ~good
            texts = _cut(self.data, begin, np.where(good, end, begin))
        return texts

    def _repeated(self, number: int, name: str) -> tuple[np.ndarray, _Fields]:
        """How many messages of the field there are up to each row, and their fields."""
        rounds, rows = [], self._next(number, _SPAN)
        while len(rows) >= _FEW:
            rows, begin, end = self._lengths(rows)
            rounds.append((rows, np.full(len(rows), len(rounds)), begin, end))
            self.at[rows] = end
            rows = rows[(self.data[end] == (number << 3 | _SPAN)) & (end < self.end[rows])]
        had = len(rounds)
        for row in rows.tolist():
            begin, end = self._rest(row, number)
            rounds.append((np.full(len(begin), row), np.arange(had, had + len(begin)), begin, end))
        rounds.append([np.zeros(0, np.int64)] * 4)
        owner, rank, *places = (np.concatenate(parts) for parts in zip(*rounds))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(self.at)))])
        # In the order of the bytes: by row, then by round.
        order = offsets[owner] + rank
        spans = np.empty((3, len(order)), np.int64)
        spans[:, order] = owner, *places
        owner, begin, end = spans
        fields = _Fields(name, self.data, begin, end)
        self.odd[owner[fields.odd]] = True
        if name == "Pair":
            self.odd[owner[_repeats(owner, fields.columns["key"])]] = True
        return offsets, fields

    def _rest(self, row: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The messages of the field that one row still has."""
        at, last, tag = int(self.at[row]), int(self.end[row]), number << 3 | _SPAN
        data, first, begins, ends = self.data[at:last].tobytes(), at, [], []
        while at < last and data[at - first] == tag:
            place, size, shift = at - first + 1, 0, 0
            while place < len(data) and shift < 35:
                size |= (data[place] & 0x7F) << shift
                place, shift = place + 1, shift + 7
                if data[place - 1] < 0x80:
                    break
            else:
                break
            if size > len(data) - place:
                break
            begins.append(first + place)
            ends.append(first + place + size)
            at = ends[-1]
        self.at[row] = at
        return np.array(begins, np.int64), np.array(ends, np.int64)


def _long_varints(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of more than one byte and their sizes, 0 where the bytes are no number."""
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))[begin]
    # The lowest of the top bits that are not set ends the number.
    stop = ~words & np.uint64(0x8080808080808080)
    stop &= -stop
    size = np.bitwise_count(stop - np.uint64(1)).astype(np.int64) // 8 + 1
    value = words & (stop | (stop - np.uint64(1))) & np.uint64(0x7F7F7F7F7F7F7F7F)
    for low, high, shift in (
        (0x007F007F007F007F, 0x7F007F007F007F00, 1),
        (0x00003FFF00003FFF, 0x3FFF00003FFF0000, 2),
        (0x000000000FFFFFFF, 0x0FFFFFFF00000000, 4),
    ):
        value = (value & np.uint64(low)) | ((value & np.uint64(high)) >> np.uint64(shift))
    wide = np.flatnonzero(size > 8)
    if len(wide):
        ninth, tenth = (data[begin[wide] + k].astype(np.uint64) for k in (8, 9))
        value[wide] |= (ninth & np.uint64(0x7F)) << np.uint64(56)
        ten = ninth >= 0x80
        value[wide] |= np.where(ten, tenth << np.uint64(63), 0).astype(np.uint64)
        size[wide] = np.where(ten, np.where(tenth <= 1, 10, 0), 9)
    return value.view(np.int64), size


def _cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes between these ascending places, as texts that are not checked."""
    if not len(begin):
        return pa.array([], pa.string())
    places = np.empty(2 * len(begin) + 1, np.int32)
    places[0:-1:2], places[1::2], places[-1] = begin, end, end[-1]
    both = pa.Array.from_buffers(pa.string(), 2 * len(begin), [None, pa.py_buffer(places), pa.py_buffer(data)])
    return both.take(pa.array(np.arange(0, 2 * len(begin), 2, dtype=np.int32)))


def _is_text(data: bytes) -> bool:
    try:
        data.decode()
        return True
    except UnicodeDecodeError:
        return False


def _repeats(owner: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Which keys their owner has had before, in any order."""
    if not len(keys):
        return np.zeros(0, bool)
    keys = keys.dictionary_encode()
    place = owner * len(keys.dictionary) + keys.indices.to_numpy()
    order = np.argsort(place, kind="stable")
    again = np.zeros(len(place), bool)
    again[order[1:]] = place[order[1:]] == place[order[:-1]]
    return again


def _as(column, kind: pa.DataType) -> pa.Array:
    """A field's values, or the lists or maps that its messages make."""
    if isinstance(column, pa.Array):
        return column
    offsets, fields = column
    offsets = pa.array(offsets, pa.int32())
    if pa.types.is_map(kind):
        return pa.MapArray.from_arrays(offsets, fields.columns["key"], fields.columns["value"], type=kind)
    return pa.ListArray.from_arrays(offsets, fields.struct(kind.value_type), type=kind)


# --- columns to bytes ------------------------------------------------------------------------


def encode(columns: dict[str, pa.Array]) -> pa.Array:
    """Message bytes of the columns of the envelope body; an Arrow error if a row may have to fail."""
    for column in columns.values():
        column.validate(full=True)
    kinds = pc.fill_null(columns["entry_type"], "ROWDATA")
    stored = [
        pc.if_else(pc.and_(pc.equal(kinds, kind), columns[column].is_valid()), _message(name, _children(columns[column])), None)
        for kind, (column, name) in _STORED.items()
    ]
    header = _message("Header", _children(columns["header"]))
    header = pc.if_else(pc.greater(pc.binary_length(header), 0), header, None)
    return _message("Entry", columns, {"header": header, "storeValue": pc.coalesce(*stored)})


def _children(column: pa.Array) -> dict[str, pa.Array]:
    return dict(zip((field.name for field in column.type), column.flatten()))


def _message(name: str, columns: dict[str, pa.Array], made: dict[str, pa.Array] | None = None) -> pa.Array:
    """The bytes of one message a row; a null field is left out."""
    column_of = {label: column for column, label in _COLUMNS[name].items()}
    parts = []
    for number, label, kind, _ in layout(name):
        if made and label in made:
            parts += _spanned(number, made[label])
        elif label not in column_of or (name, label) in _READ_ONLY:
            continue
        elif kind.startswith("*"):
            parts.append(_list(number, kind[1:], columns[column_of[label]]))
        elif kind == "string":
            parts += _spanned(number, columns[column_of[label]].cast(pa.binary()))
        else:
            parts.append(_tagged(number << 3 | _VARINT, _as_numbers(kind, columns[column_of[label]])))
    return _joined(parts)


def _as_numbers(kind: str, column: pa.Array) -> pa.Array:
    if kind == "bool":
        return column.cast(pa.bool_()).cast(pa.int32())
    if not (names := enum_names(kind)):
        return column.cast(pa.int32() if kind == "int32" else pa.int64())
    numbers = pc.add(pc.index_in(column.cast(pa.string()), pa.array(names, pa.string())), 1)
    if numbers.null_count > column.null_count:
        raise pa.ArrowInvalid(f"a name that is not of {kind}")
    return numbers


def _joined(parts: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*parts, _NOTHING, null_handling="replace", null_replacement=b"")


def _spanned(number: int, bodies: pa.Array) -> list[pa.Array]:
    return [_tagged(number << 3 | _SPAN, pc.binary_length(bodies)), bodies]


def _list(number: int, name: str, column: pa.Array) -> pa.Array:
    """The messages of a repeated field, one after the other."""
    if pa.types.is_map(column.type):
        column = column.cast(pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())])))
    messages = column.flatten()
    if messages.null_count:
        raise pa.ArrowInvalid("a null in a list")
    offsets = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
    framed = _joined(_spanned(number, _message(name, _children(messages))))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), framed), _NOTHING)


def _tagged(tag: int, numbers: pa.Array) -> pa.Array:
    """The tag and the number, null for none."""
    bounds = pc.min_max(numbers)
    if not bounds["min"].is_valid:
        return pa.nulls(len(numbers), pa.binary())
    if bounds["min"].as_py() >= 0 and bounds["max"].as_py() < 128:
        return _short(tag).take(numbers)
    # Most numbers of a batch repeat.
    different = numbers.dictionary_encode()
    return _written(tag, different.dictionary.to_numpy().astype(np.int64)).take(different.indices)


@cache
def _short(tag: int) -> pa.Array:
    return _written(tag, np.arange(128))


def _written(tag: int, numbers: np.ndarray) -> pa.Array:
    value = numbers.astype(np.int64).view(np.uint64)[:, None] >> np.arange(0, 70, 7, dtype=np.uint64).clip(max=63)
    size = np.maximum(1, (value > 0).sum(axis=1))
    written = np.empty((len(numbers), 11), np.uint8)
    written[:, 0] = tag
    written[:, 1:] = (value & np.uint64(0x7F)) | np.uint64(0x80)
    written[np.arange(len(numbers)), size] &= 0x7F
    kept = np.arange(11) <= size[:, None]
    places = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(numbers), [None, pa.py_buffer(places), pa.py_buffer(written[kept])])
