"""One record from its bytes in the fixed Avro schema; used inside Arrow batches only.

Where Spark's Avro package is deployed ``from_avro`` does this in the JVM. Encoding is an
expression, see ``avro_bytes``.
"""

from __future__ import annotations

import json

# Fixed value: field names, types and branch order of the published record schema; the record's own
# name is not part of the bytes.
RECORD_AVRO_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "ChangeRecord",
        "fields": [
            {"name": "mid", "type": "long"},
            {"name": "db", "type": "string"},
            {"name": "sch", "type": "string"},
            {"name": "tab", "type": "string"},
            {"name": "opt", "type": "string"},
            {"name": "ts", "type": "long"},
            {"name": "ddl", "type": ["string", "null"]},
            {"name": "err", "type": ["string", "null"]},
            {"name": "src", "type": [{"type": "map", "values": ["string", "null"]}, "null"]},
            {"name": "cur", "type": [{"type": "map", "values": ["string", "null"]}, "null"]},
            {"name": "cus", "type": [{"type": "map", "values": ["string", "null"]}, "null"]},
        ],
    }
)

def _kind(field: dict) -> str:
    """'long', 'string' or 'map', with '?' where null is the other branch."""
    kind = field["type"]
    optional = isinstance(kind, list)
    kind = kind[0] if optional else kind
    return (kind["type"] if isinstance(kind, dict) else kind) + "?" * optional


_LAYOUT = tuple((field["name"], _kind(field)) for field in json.loads(RECORD_AVRO_SCHEMA)["fields"])


def decode_record(data: bytes) -> dict:
    record, at = {}, 0
    for name, kind in _LAYOUT:
        if kind.endswith("?"):
            branch, at = _get_long(data, at)
            if branch == 1:
                record[name] = None
                continue
        if kind == "long":
            record[name], at = _get_long(data, at)
        elif kind.startswith("string"):
            record[name], at = _get_text(data, at)
        else:
            record[name], at = _get_map(data, at)
    if at > len(data):
        raise ValueError("record bytes end early")
    return record


def _get_long(data: bytes, at: int) -> tuple[int, int]:
    folded = shift = 0
    while True:
        byte = data[at]
        at += 1
        folded |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (folded >> 1) ^ -(folded & 1), at
        shift += 7


def _get_text(data: bytes, at: int) -> tuple[str, int]:
    length, at = _get_long(data, at)
    if length < 0 or at + length > len(data):
        raise ValueError("text runs past the end of the record")
    return data[at : at + length].decode("utf-8"), at + length


def _get_map(data: bytes, at: int) -> tuple[dict, int]:
    entries: dict = {}
    while True:
        count, at = _get_long(data, at)
        if count == 0:
            return entries, at
        if count < 0:  # a block that also states its size in bytes
            count = -count
            _, at = _get_long(data, at)
        for _ in range(count):
            key, at = _get_text(data, at)
            branch, at = _get_long(data, at)
            entries[key] = None
            if branch == 0:
                entries[key], at = _get_text(data, at)
