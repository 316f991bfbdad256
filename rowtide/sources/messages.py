"""Message layout of the envelope wire format, for Protobuf decoders.

``descriptor_set`` is the serialized descriptor that Spark's ``from_protobuf`` takes;
``message_class`` is the Python counterpart for Arrow batches.
"""

from __future__ import annotations

from functools import cache

from rowtide.schemas import ENTRY_TYPES, EVENT_TYPES, SOURCE_TYPES

# Not part of the wire format, so the name is ours.
PACKAGE = "rowtide.wire"

# Field numbers, names, types and defaults of the wire format. A leading '*' marks
# a repeated field; capitalised types are other messages or enums of this list.
_LAYOUT = {
    "Pair": ("1 key string", "2 value string"),
    "Entry": (
        "1 header Header", "2 entryType EntryType ROWDATA", "3 storeValue bytes",
        "4 batchId int64", "5 inId int64", "6 ip string",
    ),
    "Header": (
        "1 version int32 1", "2 logfileName string", "3 logfileOffset int64",
        "4 serverId int64", "5 serverenCode string", "6 executeTime int64",
        "7 sourceType Type MYSQL", "8 schemaName string", "9 tableName string",
        "10 eventLength int64", "11 eventType EventType UPDATE", "12 props *Pair",
    ),
    "Column": (
        "1 index int32", "2 sqlType int32", "3 name string", "4 isKey bool", "5 updated bool",
        "6 isNull bool false", "7 props *Pair", "8 value string", "9 length int32",
        "10 mysqlType string",
    ),
    "RowData": ("1 beforeColumns *Column", "2 afterColumns *Column", "3 props *Pair"),
    "RowChange": (
        "1 tableId int64", "2 eventType EventType UPDATE", "10 isDdl bool false",
        "11 sql string", "12 rowDatas *RowData", "13 props *Pair", "14 ddlSchemaName string",
    ),
    "TransactionBegin": (
        "1 executeTime int64", "2 transactionId string", "3 props *Pair", "4 threadId int64",
    ),
    "TransactionEnd": ("1 executeTime int64", "2 transactionId string", "3 props *Pair"),
}
_ENUMS = {"EntryType": ENTRY_TYPES, "EventType": EVENT_TYPES, "Type": SOURCE_TYPES}


@cache
def layout(name: str) -> list[tuple[int, str, str, int]]:
    """Number, name, kind and default of the fields of a message, by number."""
    fields = []
    for line in _LAYOUT[name]:
        number, label, kind, *default = line.split()
        names, default = enum_names(kind), default[0] if default else "0"
        fields.append((int(number), label, kind, names.index(default) + 1 if names else int(default.replace("false", "0"))))
    return sorted(fields)


def enum_names(kind: str) -> tuple[str, ...]:
    """Names of an enum from number one on; none for other kinds."""
    return _ENUMS.get(kind, ())


@cache
def _file():
    from google.protobuf import descriptor_pb2

    field = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(
        name="envelope.proto", package=PACKAGE, syntax="proto2"
    )
    for name, members in _ENUMS.items():
        enum = file.enum_type.add(name=name)
        for number, member in enumerate(members, start=1):
            enum.value.add(name=member, number=number)
    for name, lines in _LAYOUT.items():
        message = file.message_type.add(name=name)
        for line in lines:
            number, label, kind, *default = line.split()
            added = message.field.add(name=label, number=int(number))
            added.label = field.LABEL_REPEATED if kind[0] == "*" else field.LABEL_OPTIONAL
            kind = kind.lstrip("*")
            if kind in _ENUMS or kind in _LAYOUT:
                added.type = field.TYPE_ENUM if kind in _ENUMS else field.TYPE_MESSAGE
                added.type_name = f".{PACKAGE}.{kind}"
            else:
                added.type = getattr(field, f"TYPE_{kind.upper()}")
            if default:
                added.default_value = default[0]
    return file


def descriptor_set() -> bytes:
    from google.protobuf import descriptor_pb2

    return descriptor_pb2.FileDescriptorSet(file=[_file()]).SerializeToString()


@cache
def message_class(name: str):
    from google.protobuf import descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    pool.Add(_file())
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.{name}"))
