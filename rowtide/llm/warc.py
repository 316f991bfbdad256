"""WARC archives: written with one gzip member per record, read by byte ranges (operator 10).

A reading task gets a byte range of a file. It looks for the gzip magic, inflates the start of a
candidate member and accepts it if a WARC version line (1.0, 1.1 or another 1.x) and a well-formed
header follow, its own checksum holds and its length is the header's. A record belongs to the range
in which its member starts; the task reads on past the end of its range as far as that record goes.
From its end the next member follows. Where none does, bytes are damaged: the search goes on behind
them, so a damaged record costs no other, and ``damaged_stretches`` tells what was passed over. A
response whose payload does not have the SHA-1 it tells counts as damaged.

A range that begins inside a record may find records stored within it (an archive in an archive).
They end where that record ends at the latest, so a range keeps what starts behind the ends of the
ranges before. Records inside a damaged one cannot be told from others and are given out.

Nulls and ties: a null payload counts as empty; a null url leaves the field out, control characters
in one are percent-encoded. Rows without a page_id are written without that field; they are smaller
than any id, and equal payloads that all lack an id are all responses. Rows that repeat the largest
page_id of a payload are all responses. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.shared import file_system, new_file, prepare, shared_folder, stage

VERSION = b"WARC/1.1\r\n"
_VERSION = re.compile(rb"WARC/1\.\d{1,4}\r\n")
_VERSION_BYTES = 13
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Compressed bytes after which an archive is closed, and bytes of a reading task's range.
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
_STEP = 1 << 16
_BATCH_BYTES = 8 << 20
#: What a header can begin with that has not ended yet: whole fields, then a field or a part of a name.
#: A line that begins with white space goes on with the field before.
_FIELDS = re.compile(rb"(?:(?:[!-9;-~]+:|[ \t])[^\r\n]*+\r\n)*+(?:(?:[!-9;-~]+:|[ \t])[^\r\n]*+|[!-9;-~]*+)\r?(?:\n\r?)?\Z")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_kinds(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Adds refers_to: the largest page_id of the pages with the same payload, null on that page.

    Only digests that occur twice are joined back; they are counted within each task first.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"), F.sha1(payload).alias("digest")
    )
    repeated = (
        pages.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return pages.join(repeated, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    body = HTTP if refers_to is not None else HTTP + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(body))))
    head = VERSION + "".join(f"{name}: {value}\r\n" for name, value in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


_FILES = pa.schema([("path", pa.string()), ("n_bytes", pa.int64()), ("n_records", pa.int64())])


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records (page_id, url, payload, refers_to) to archives; a row per file.

    A task streams into its file and closes it at the next record after ``archive_bytes``.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            path = f"{folder}/part-{part:06d}-{number:06d}-{uuid.uuid4().hex[:8]}.warc.gz"
            size = count = 0
            with new_file(path) as out:
                while row is not None and size < archive_bytes:
                    data = record_bytes(*row)
                    out.write(data)
                    size, count = size + len(data), count + 1
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "n_bytes": [size], "n_records": [count]}, schema=_FILES)
            number += 1

    chosen = records.select("page_id", "url", "payload", "refers_to")
    return chosen.mapInArrow(write, "path string, n_bytes long, n_records long")


class _Window:
    """Bytes of a file from some place on, read in steps and let go behind the reader."""

    def __init__(self, source, at: int, size: int):
        self.source, self.start, self.size, self.held = source, at, size, b""

    def get(self, at: int, n: int) -> bytes:
        """At most n bytes from there; fewer at the end of the file."""
        if at < self.start:
            self.start, self.held = at, b""
        if at + n > self.start + len(self.held):
            kept = self.held[at - self.start :] if at < self.start + len(self.held) else b""
            self.source.seek(at + len(kept))
            self.held, self.start = kept + self.source.read(max(n - len(kept), _STEP)), at
        return self.held[at - self.start : at - self.start + n]


def _member(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header fields, block and the place behind the member that starts there; None if none does."""
    if window.get(at, 3) != MAGIC:
        return None
    unpack, got, place, head_end = zlib.decompressobj(31), [], at, -1
    start, checked, version = bytearray(), 0, None
    try:
        while not unpack.eof:
            data = window.get(place, _STEP)
            if not data:
                return None
            piece = unpack.decompress(data)
            place += len(data) - len(unpack.unused_data)
            got.append(piece)
            if head_end < 0:
                start += piece
                version = version or _VERSION.match(start)
                if version is None:
                    if len(start) >= _VERSION_BYTES or not start.startswith(VERSION[:7][: len(start)]):
                        return None
                    continue
                checked = max(checked, version.end())
                head_end = start.find(b"\r\n\r\n", max(0, len(start) - len(piece) - 3))
                if head_end < 0 and len(start) > checked and not _FIELDS.match(start, checked):
                    return None
                checked = max(checked, start.rfind(b"\n") + 1)
    except zlib.error:
        return None
    if head_end < 0:
        return None
    whole = b"".join(got)
    fields: dict[str, str] = {}
    last = None
    for line in whole[version.end() : head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line[:1] in (b" ", b"\t") and last is not None:
            fields[last] += " " + line.strip().decode("utf-8", "replace")
        elif colon:
            last = name.decode("utf-8", "replace").lower()
            fields[last] = value.strip().decode("utf-8", "replace")
        else:
            return None
    length = fields.get("content-length", "")
    if not length.isdigit() or len(whole) != head_end + 4 + int(length) + 4:
        return None
    return fields, whole[head_end + 4 : -4], place


def read_range(source, size: int, low: int, high: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Start, end, header fields and block of the members that start in [low, high), one after another.

    What is no whole member is passed over, up to the next place where one begins. A range that begins
    inside a member may find one that is stored within it; see ``kept_members``.
    """
    window, at = _Window(source, low, size), low
    while at < high:
        data = window.get(at, _STEP + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            if at >= size or len(data) < len(MAGIC):
                return
            continue
        first = at + found
        if first >= high:
            return
        member = _member(window, first)
        if member is None:
            at = first + 1
            continue
        yield first, member[2], member[0], member[1]
        at = member[2]


def _record(fields: dict[str, str], block: bytes) -> tuple | None:
    """The columns of a record; None if its payload does not have the SHA-1 it tells."""
    number = lambda name: int(fields[name]) if name in fields else None
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    length = number("x-payload-length")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        length = len(payload)
        if fields.get("warc-payload-digest", "").startswith("sha1:") and payload_digest(payload) != digest.upper():
            return None
    return number("x-page-id"), fields.get("warc-target-uri"), length, digest, kind, number("x-refers-to-page-id"), payload


_RECORDS = pa.schema(
    [
        ("path", pa.string()),
        ("low", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_DDL = (
    "path string, low long, start long, end long, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def range_members(files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The members of archives (path, n_bytes) by the byte ranges that tasks share out, with their places."""
    schema = _RECORDS if payloads else pa.schema(list(_RECORDS)[:-1])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files_, at = file_system(path)
                rows: list[tuple] = []
                held = 0
                with files_.open_input_file(at) as source:
                    for start, end, fields, block in read_range(source, size, low, min(size, low + range_bytes)):
                        record = _record(fields, block)
                        if record is None:
                            continue
                        rows.append((path, low, start, end, *record))
                        held += len(block)
                        if len(rows) == 256 or held >= _BATCH_BYTES:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    ranges = files.where("n_bytes > 0").select(
        "path", "n_bytes", F.explode(F.expr(f"sequence(0L, n_bytes - 1, {range_bytes}L)")).alias("low")
    )
    ddl = _DDL if payloads else _DDL.rpartition(",")[0]
    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return ranges.repartition(tasks, "path", "low").mapInArrow(read, ddl)


def kept_members(members: DataFrame) -> DataFrame:
    """Members that do not lie inside one of a range before: those are records stored within a record.

    A range's members follow each other, so the ends of the ranges are enough: a row per range that
    has members meets in the window of its file.
    """
    before = Window.partitionBy("path").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    ends = members.groupBy("path", "low").agg(F.max("end").alias("_end"))
    ends = ends.select("path", "low", F.max("_end").over(before).alias("_before")).where("_before > low")
    return members.join(ends, ["path", "low"], "left").where("_before is null or start >= _before").drop("_before")


def read_members(files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of archives (path, n_bytes) with their place: path, start and end.

    The members of all ranges are written to the shared folder before those inside others are left out.
    """
    return kept_members(stage(range_members(files, range_bytes, payloads))).drop("low")


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of archives (path, n_bytes), each file cut into byte ranges that tasks share out."""
    return read_members(files, range_bytes, payloads).drop("path", "start", "end")


def damaged_stretches(files: DataFrame, members: DataFrame) -> DataFrame:
    """path, low, high: the bytes of archives (path, n_bytes) that are in no record (path, start, end).

    A window of a file holds its records' places, so no more than an archive has records.
    """
    marks = members.select("path", "start", "end")
    whole = files.select("path", F.col("n_bytes").alias("start"), F.col("n_bytes").alias("end"))
    before = Window.partitionBy("path").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.max("end").over(before), F.lit(0).cast("long"))
    return marks.unionByName(whole).select("path", low.alias("low"), F.col("start").alias("high")).where("low < high")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))[: len(schema)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def archive_round_trip(pages: DataFrame, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read the records back by ranges."""
    spark = prepare(pages.sparkSession)
    folder = shared_folder(spark)
    files = stage(write_archives(record_kinds(pages, min_revisit_bytes), folder, archive_bytes))
    records = read_archives(files, payloads=False)
    written, read = files.agg(F.sum("n_records")).first()[0] or 0, records.count()
    if read != written:
        raise ValueError(f"{read} records were read of {written} written")
    return records
