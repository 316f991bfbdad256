"""Token ids of documents in files of entropy-coded blocks (operator 8).

The texts are encoded by a public tokenizer, one closing id is added to each, and the ids are
written in document order to files of range-coded blocks under one shared frequency table.
A file holds whole documents only: magic, segments (lane states, words), then an index (documents,
segments with offset and checksum, checksum of the table) and its length.

Nulls and ties: a null text counts as empty, so the document has its closing id only. Documents
without an id come first. Rows that repeat an id are all kept, ordered by their ids' checksum and
count. Other columns are not read. An empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm import rans
from rowtide.llm.shared import file_system, new_file, prepare, shared_folder, stage

MAGIC = b"RTIDS\x01\r\n"
#: Tokens after which a file is closed, at the end of a document.
FILE_TOKENS = 2_000_000
#: Blocks that are coded in one array.
TOGETHER = 40
#: Text that is cut into chunks at once.
SLICE_BYTES = 8 << 20
#: Entries of a generation of each of a worker's two word caches.
CACHE = 250_000

# Latin letters, then ASCII marks: such a chunk is its letters and its marks, each one pre-token.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!#$%&*,./:;?|]+)")
# A comma or full stop at the end of a chunk that continues a run of marks.
_RUN = re.compile(r"[.,] (?<![^\W_][.,] )(?<! [.,] )")
_PROBES = ("a", "the", "Tokens", "internationalization", "zqxjkvb")
_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


class _Recent:
    """Forgets what has not been used lately: two generations of bounded size."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known

    def recall(self, keys: set[str]) -> list[str]:
        """Takes over those of the keys that the older generation has; the rest is returned."""
        older = self.older
        found = keys & older.keys()
        self.known.update((key, older[key]) for key in found)
        return list(keys - found)


class WordEncoder:
    """Encodes chunks between spaces once and keeps their ids, as little-endian bytes.

    For tokenizers that compose accents, drop white space, lower-case letters, take runs of letters
    and of marks as pre-tokens and never join across them.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        self.end = np.array([end_id], self.kind).tobytes()
        self.chunks, self.parts = _Recent(), _Recent()
        self.model = self.tokenizer.model
        # The model alone is half the work, where it gives a word of ASCII letters the ids of the whole tokenizer.
        self.direct = all(self._of_model(w) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in _PROBES)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _of_model(self, word: str) -> list[int]:
        return [token.id for token in self.model.tokenize(word.lower())]

    def _encode_words(self, words: list[str], known: dict[str, bytes]) -> None:
        """Keeps the ids of words of ASCII letters."""
        ids, ends = [], []
        for word in words:
            ids += self._of_model(word)
            ends.append(len(ids))
        coded = self._bytes(ids)
        width, begin = len(self.end), 0
        for word, end in zip(words, ends, strict=True):
            known[word] = coded[begin : end * width]
            begin = end * width

    def _encode_parts(self, parts: list[str], known: dict[str, bytes]) -> None:
        """Keeps the ids of pre-tokens; all but words of ASCII letters are encoded in one text."""
        if self.direct:
            words = [p for p in parts if p.isascii() and p.isalpha()]
            if words:
                self._encode_words(words, known)
                parts = [p for p in parts if not (p.isascii() and p.isalpha())]
        if not parts:
            return
        encoding = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = self._bytes(encoding.ids)
        width = len(ids) // len(encoding.ids)
        ends = np.cumsum(np.bincount(np.array(encoding.word_ids), minlength=len(parts))) * width
        begin = 0
        for part, end in zip(parts, ends.tolist(), strict=True):
            known[part] = ids[begin:end]
            begin = end

    def _learn(self, new: set[str]) -> None:
        letters, plain, other, parts, chunks = [], [], [], self.parts.known, self.chunks.known
        for chunk in self.chunks.recall(new):
            if chunk.isalpha() and (chunk.isascii() or max(chunk) <= "ÿ"):
                letters.append(chunk)
            elif match := _PLAIN.fullmatch(chunk):
                plain.append((chunk, *match.groups()))
            else:
                other.append(chunk)
        self._encode_parts(letters, chunks)
        wanted = {p for _, a, b in plain for p in (a, b)}.difference(parts)
        self._encode_parts(self.parts.recall(wanted), parts)
        for chunk, word, marks in plain:
            chunks[chunk] = parts[word] + parts[marks]
        if other:
            coded = self.tokenizer.encode_batch(other, add_special_tokens=False)
            for chunk, encoding in zip(other, coded, strict=True):
                chunks[chunk] = self._bytes(encoding.ids)

    @staticmethod
    def _prepared(text: str) -> str:
        """The text with single spaces between chunks that can be encoded one by one.

        Latin-1 text is lower-cased here, as the tokenizer would, and commas and full stops behind
        a word are cut off, so that there are fewer chunks to know. No letter of it changes under
        the tokenizer's composition of accents.
        """
        text = text.replace("\n", " ")
        try:
            text.isascii() or text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        text = text.lower()
        if not _RUN.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the closing id.

        The texts are cut and their chunks numbered by Arrow, so only different chunks become Python objects.
        """
        chunks = pc.split_pattern(pa.array([self._prepared(text or "") for text in texts], pa.string()), " ")
        numbered = chunks.flatten().dictionary_encode()
        different = numbered.dictionary.to_pylist()
        self.chunks.turn()
        self.parts.turn()
        known = self.chunks.known
        if new := set(different).difference(known):
            self._learn(new)
        ids = pa.array([known[chunk] for chunk in different], pa.binary()).take(numbered.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int32)[chunks.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[begin:end]) + self.end for begin, end in zip(ends, ends[1:], strict=False)]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in slices of SLICE_BYTES of text at most; a longer text shares its slice with empty ones only."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    yield batch.slice(begin)


def _encoder(path: str, end_id: int) -> WordEncoder:
    """One per worker process, so that what it has learnt serves its later tasks too."""
    if (path, end_id) not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def encode_documents(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, crc (of all ids) and ids (little-endian 16 or 32 bits each)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, end_id)
        narrow = encoder.kind == "<u2"
        for batch in batches:
            for rows in _slices(batch):
                coded = encoder.encode(rows.column(1).to_pylist())
                sizes = [len(ids) // (2 if narrow else 4) for ids in coded]
                crcs = [zlib.crc32(_ids(ids, narrow).astype("<u4")) for ids in coded]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array([narrow] * len(coded), pa.bool_()),
                        pa.array(coded, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "crc", "narrow", "ids"],
                )

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(encode, "doc_id long, n_tokens long, crc long, narrow boolean, ids binary")


def _ids(row_ids: bytes, narrow: bool) -> np.ndarray:
    return np.frombuffer(row_ids, "<u2" if narrow else "<u4")


def token_counts(encoded: DataFrame) -> DataFrame:
    """token, n over all documents; each task sums its own before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            coded = batch.column(1).to_pylist()
            for narrow in set(batch.column(0).to_pylist()):
                kinds = zip(batch.column(0).to_pylist(), coded, strict=True)
                found = np.bincount(_ids(b"".join(ids for kind, ids in kinds if kind == narrow), narrow))
                if len(found) > len(total):
                    found[: len(total)] += total
                    total = found
                else:
                    total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["token", "n"])

    counts = encoded.select("narrow", "ids").mapInArrow(count, "token long, n long")
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def table_bytes(freq: np.ndarray) -> bytes:
    body = np.asarray(freq, "<u4").tobytes()
    return struct.pack("<8sII", MAGIC, len(freq), zlib.crc32(body)) + body


def read_table(data: bytes) -> np.ndarray:
    magic, n, crc = struct.unpack_from("<8sII", data)
    body = data[16 : 16 + 4 * n]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("the frequency table is damaged")
    return np.frombuffer(body, "<u4").astype(np.int64)


def write_file(out, table: rans.Table, table_crc: int, doc_ids: list[int | None], sizes: list[int], tokens: np.ndarray) -> None:
    """One file: segments first, so that they are written as they are made."""
    out.write(MAGIC)
    at, segments = len(MAGIC), []
    full = len(tokens) // rans.BLOCK
    batches = [
        tokens[i * rans.BLOCK : min(full, i + TOGETHER) * rans.BLOCK].reshape(-1, rans.BLOCK) for i in range(0, full, TOGETHER)
    ]
    if len(tokens) > full * rans.BLOCK:
        batches.append(tokens[None, full * rans.BLOCK :])
    for batch in batches:
        for n, states, words in rans.encode_block(table, batch):
            data = states.astype("<u8").tobytes() + words.astype("<u4").tobytes()
            segments.append((at, n, len(words), zlib.crc32(data)))
            out.write(data)
            at += len(data)
    index = b"".join(
        (
            struct.pack("<QQQ", len(doc_ids), len(segments), table_crc),
            np.array([i is not None for i in doc_ids], "<u1").tobytes(),
            np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
            np.array(sizes, "<i8").tobytes(),
            np.array(segments, "<u8").reshape(-1, 4).tobytes(),
        )
    )
    out.write(index + struct.pack("<QI8s", len(index), zlib.crc32(index), MAGIC))


def read_index(source) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """Checksum of the table, ids and sizes of the documents, and the segments of an open file."""
    end = source.size()
    source.seek(end - 20)
    length, crc, magic = struct.unpack("<QI8s", source.read(20))
    source.seek(end - 20 - length)
    index = source.read(length)
    if magic != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("the index of a token file is damaged")
    docs, n, table_crc = struct.unpack_from("<QQQ", index)
    known = np.frombuffer(index, "<u1", docs, 24)
    ids = np.frombuffer(index, "<i8", docs, 24 + docs)
    sizes = np.frombuffer(index, "<i8", docs, 24 + 9 * docs)
    segments = np.frombuffer(index, "<u8", 4 * n, 24 + 17 * docs).reshape(-1, 4).astype(np.int64)
    return table_crc, [int(i) if k else None for i, k in zip(ids, known, strict=True)], sizes, segments


def read_segments(source, table: rans.Table, segments: np.ndarray) -> np.ndarray:
    """Tokens of some consecutive segments of an open file; any such range can be read alone."""
    states, words, sizes = [], [], []
    for at, n, n_words, crc in segments.tolist():
        source.seek(at)
        data = source.read(8 * rans.LANES + 4 * n_words)
        if zlib.crc32(data) != crc:
            raise ValueError(f"the segment at {at} of a token file is damaged")
        sizes.append(n)
        states.append(np.frombuffer(data, "<u8", rans.LANES))
        words.append(np.frombuffer(data, "<u4", n_words, 8 * rans.LANES))
    if not sizes:
        return np.zeros(0, np.uint32)
    return np.concatenate(rans.decode_segments(table, sizes, np.array(states), words))


def write_token_files(encoded: DataFrame, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the files in ascending order of doc_id; a row per file: part, number, path, tokens, documents.

    The frequency table has one entry per token of the vocabulary, so it is small on any input and
    is handed to the tasks as it is. Ties of an id are split by checksum and count.
    """
    counts = np.zeros(1, np.int64)
    for row in token_counts(encoded).toLocalIterator():  # at most one row per entry of the vocabulary
        if row.token >= len(counts):
            counts = np.concatenate([counts, np.zeros(row.token + 1 - len(counts), np.int64)])
        counts[row.token] = row.n
    stored = table_bytes(rans.quantized(counts))
    with new_file(f"{folder}/table.freq") as out:
        out.write(stored)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, crc = rans.Table(read_table(stored)), zlib.crc32(stored)
        part, number = TaskContext.get().partitionId(), 0
        ids, sizes, tokens, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{number:06d}-{uuid.uuid4().hex[:8]}.rtids"
            with new_file(path) as out:
                write_file(out, table, crc, ids, sizes, np.concatenate(tokens))
            row = {"part": [part], "number": [number], "path": [path], "n_tokens": [held], "n_docs": [len(ids)]}
            return pa.RecordBatch.from_pydict(row, schema=_FILES)

        for batch in batches:
            for doc_id, narrow, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                new = _ids(data, narrow)
                ids.append(doc_id)
                sizes.append(len(new))
                tokens.append(new.astype(np.uint32))
                held += len(new)
                if held >= file_tokens:
                    yield flush()
                    ids, sizes, tokens, held, number = [], [], [], 0, number + 1
        if ids:
            yield flush()

    parts = max(1, int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["doc_id", "crc", "n_tokens"]
    placed = encoded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return placed.select("doc_id", "narrow", "ids").mapInArrow(
        write, "part long, number long, path string, n_tokens long, n_docs long"
    )


_FILES = pa.schema(
    [("part", pa.int64()), ("number", pa.int64()), ("path", pa.string()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]
)


def with_starts(files: DataFrame) -> DataFrame:
    """Adds the tokens of all files before; parts are summed first, so no task sees every file."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(parts, "part").select(
        "path", (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"), "n_tokens"
    )


def read_token_files(files: DataFrame, folder: str, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """A row per document of the files (path, start): doc_id, start, n_tokens and the crc of its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, step = None, TOGETHER * (rans.STEPS // rans.EVERY)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if table is None:
                    files_, at = file_system(f"{folder}/table.freq")
                    with files_.open_input_file(at) as source:
                        stored = source.read()
                    table, crc = rans.Table(read_table(stored)), zlib.crc32(stored)
                files_, at = file_system(path)
                with files_.open_input_file(at) as source:
                    table_crc, ids, sizes, segments = read_index(source)
                    if table_crc != crc:
                        raise ValueError(f"{path} was written under another frequency table")
                    tokens = np.concatenate(
                        [np.zeros(0, np.uint32)]
                        + [read_segments(source, table, segments[i : i + step]) for i in range(0, len(segments), step)]
                    ).astype("<u4")
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(starts + start, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([zlib.crc32(tokens[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = files.select("path", "start").repartition(tasks, "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(documents: DataFrame, tokenizer: str, end_id: int = 2, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode, write and read back: doc_id, start, n_tokens, ids_crc32 as the files have them.

    The encoded ids and the list of files are kept in the shared folder, so a lost executor repeats
    its own tasks only and never writes a file that the list does not name.
    """
    spark = prepare(documents.sparkSession)
    folder = shared_folder(spark)
    encoded = stage(encode_documents(documents, tokenizer, end_id))
    files = stage(write_token_files(encoded, folder, file_tokens))
    return read_token_files(with_starts(files), folder)
