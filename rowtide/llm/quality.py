"""Quality rules: base counts, and divergence from the language's usual histograms (operator 3).

A document's character classes and common words are compared with those of its language by the
Jensen-Shannon distance. The references come from all documents of the language that pass the base
rules, each with equal weight: mean shares of eight character classes, and of the words that make
up at least ``COMMON_SHARE`` of the words of all its documents, 32 at most (the rest is one share).

Finding those words takes no shuffle of the vocabulary: each task keeps a bounded summary of
frequent words per language (Misra-Gries), whose sums miss no word of that share; the words it
leaves are counted exactly. The divergence is only judged from a minimum length on.

Nulls and ties: a null text has no words and fails the base rules. Documents without a language
form one of their own. A language whose documents all fail has no reference, and its documents are
judged by the base rules alone. Rows that repeat a document are judged alike, each for itself.
Other columns pass through ``good_documents`` untouched. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.shared import prepare, stage

MIN_WORDS = 50
#: Lengths from which each histogram is judged, and the distances beyond which it fails.
CLASS_WORDS, CLASS_DISTANCE = 50, 0.33
WORD_WORDS, WORD_DISTANCE = 100, 0.38
COMMON_SHARE, COMMON_WORDS = 0.005, 32
#: Counters a task keeps per language; sums then lack less than 1/SUMMARY of the words.
SUMMARY = 2_000

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_MARKS = b".,;:!?\"'()[]{}#*$%&|<>-_=+/\\~^`@"
CLASSES = ("lower", "upper", "digit", "symbol", "mark", "other_ascii", "letter", "other")


def _class_of(point: int) -> int:
    """Index into CLASSES; -1 for white space."""
    char = chr(point)
    if char in SPACES:
        return -1
    if char in SYMBOLS:
        return 3
    if point < 128:
        if char.isalnum():
            return 2 if char.isdigit() else 1 if char.isupper() else 0
        return 4 if char in ".,;:!?'\"-()" else 5
    return 6 if char.isalpha() else 7


# Classes of the first code points by table; the rest are looked up as they come.
_TABLE = np.array([_class_of(i) for i in range(0x250)], np.int8)


def class_counts(text: str) -> list[int]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    near = points < len(_TABLE)
    counts = np.bincount(_TABLE[points[near]] + 1, minlength=9)[1:]
    if not near.all():
        found, times = np.unique(points[~near], return_counts=True)
        for point, n in zip(found.tolist(), times.tolist(), strict=True):
            counts[_class_of(point)] += n
    return counts.tolist()


def plain_words(text: str) -> list[bytes]:
    """Words in lower case without marks."""
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _MARKS).split()


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    repeated = 0
    if len(times) < len(windows):
        again = np.zeros(n + 1, np.int32)
        at = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, len(windows)))
        np.add.at(again, at, 1)
        np.add.at(again, np.minimum(at + 3, n), -1)
        repeated = int((np.cumsum(again[:-1]) > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


class _Frequent:
    """Misra-Gries summary of words: counts lack at most 1/SUMMARY of all that were added."""

    def __init__(self) -> None:
        self.total, self.counts = 0, Counter()

    def add(self, words: list[bytes]) -> None:
        self.total += len(words)
        self.counts.update(words)
        if len(self.counts) > 20 * SUMMARY:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > SUMMARY:
            values = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            less = int(np.partition(values, len(values) - SUMMARY - 1)[len(values) - SUMMARY - 1])
            self.counts = Counter({w: c - less for w, c in self.counts.items() if c > less})


def _language(documents: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


def frequent_words(documents: DataFrame) -> DataFrame:
    """lang, words: every word that may have COMMON_SHARE of the words of its language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, _Frequent] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen.setdefault(lang, _Frequent()).add(plain_words(text.as_py() or ""))
        for lang, found in seen.items():
            found.shrink()
            words = [None, *(w.decode("utf-8", "replace") for w in found.counts)]
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(words), "word": words, "n": [found.total, *found.counts.values()]},
                schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]),
            )

    chosen = documents.select(_language(documents).alias("lang"), F.col("text").cast("string"))
    counts = stage(chosen.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    total = counts.where("word is null").select("lang", F.col("n").alias("total"))
    enough = F.col("n") >= F.col("total") * (COMMON_SHARE - 1 / SUMMARY)
    kept = counts.where("word is not null").join(total, "lang").where(enough & (F.col("n") > 0))
    # At most 1 / (COMMON_SHARE - 1 / SUMMARY) words can be left of a language.
    return kept.groupBy("lang").agg(F.sort_array(F.collect_list("word")).alias("words"))


def measured(documents: DataFrame, words: DataFrame) -> DataFrame:
    """All columns of the documents, the base counts, class counts and counts of the given words.

    The list of words per language is small and on disk, so Spark knows its size and broadcasts it
    only if it is.
    """
    names = documents.columns
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, common in zip(batch.column("_text"), batch.column("_words").to_pylist(), strict=True):
                text = text.as_py() or ""
                found = Counter(plain_words(text))
                rows.append(
                    (*base_counts(text), class_counts(text), [found[w.encode("utf-8", "surrogatepass")] for w in common or ()])
                )
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
            added = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            kept = [batch.column(i) for i in range(len(batch.schema)) if batch.schema.names[i] not in ("_text", "_words")]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*out])

    kept = [f"_d{i}" for i in range(len(names))]
    own = documents.toDF(*kept) if names else documents
    lang, text = (F.col(kept[names.index(c)]).cast("string") for c in ("lang", "text"))
    joined = own.withColumn("_lang", F.coalesce(lang, F.lit(""))).withColumn("_text", text)
    joined = joined.join(words.select(F.col("lang").alias("_lang"), F.col("words").alias("_words")), "_lang", "left")
    out = ["_lang", *kept, *(c.split()[0] for c in counts.split(", ")), "classes", "common"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    schema = f"_lang string, {fields}, {counts}, classes array<long>, common array<long>"
    return joined.select("_lang", *kept, "_text", "_words").mapInArrow(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(rows: DataFrame) -> DataFrame:
    """_lang, class_ref, places (of the common words kept) and word_ref, the last share being the rest."""
    good = rows.where(~base_failed())
    words = rows.groupBy("_lang").agg(F.sum("n_words").alias("all_words"))
    n = F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)
    classes = good.groupBy("_lang").agg(
        F.array(*(F.avg(F.col("classes")[i] / n) for i in range(len(CLASSES)))).alias("class_ref")
    )
    each = rows.select("_lang", "n_words", base_failed().alias("bad"), F.posexplode("common").alias("place", "n"))
    share = F.avg(F.when(~F.col("bad"), F.col("n") / F.col("n_words"))).alias("share")
    shares = each.groupBy("_lang", "place").agg(share, F.sum("n").alias("n")).where("share is not null")
    shares = shares.join(words, "_lang").where(F.col("n") >= COMMON_SHARE * F.col("all_words"))
    ranked = shares.withColumn("rank", F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("n"), "place")))
    kept = ranked.where(F.col("rank") <= COMMON_WORDS).groupBy("_lang").agg(
        F.sort_array(F.collect_list(F.struct("place", "share"))).alias("kept")
    )
    whole = F.aggregate("kept.share", F.lit(0.0), lambda a, b: a + b)
    kept = kept.select("_lang", F.col("kept.place").alias("places"), F.concat("kept.share", F.array(F.greatest(F.lit(0.0), 1 - whole))).alias("word_ref"))
    return classes.join(kept, "_lang", "left")


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, to base 2, of counts and shares; null where either is missing."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(F.transform(counts, lambda c: c / total), reference, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2)))


def judged(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """The documents with their counts, both distances, base_failed and kept; and their columns' names.

    The documents' own columns are called _d0, _d1 and so on, so that no name can clash.
    """
    prepare(documents.sparkSession)
    names = documents.columns
    rows = stage(measured(documents, stage(frequent_words(documents))))
    rows = rows.join(stage(references(rows)), "_lang", "left")
    common = F.transform("places", lambda p: F.col("common")[p])
    rest = F.greatest(F.lit(0).cast("long"), F.col("n_words") - F.aggregate(common, F.lit(0).cast("long"), lambda a, b: a + b))
    rows = rows.withColumns(
        {
            "class_distance": distance(F.col("classes"), F.col("class_ref")),
            "word_distance": distance(F.concat(common, F.array(rest)), F.col("word_ref")),
            "base_failed": base_failed(),
        }
    )
    off = lambda d, most, least: (F.col("n_words") >= least) & F.coalesce(F.col(d) > most, F.lit(False))
    diverges = off("class_distance", CLASS_DISTANCE, CLASS_WORDS) | off("word_distance", WORD_DISTANCE, WORD_WORDS)
    return rows.withColumn("kept", ~F.col("base_failed") & ~diverges), names


def quality_report(documents: DataFrame) -> DataFrame:
    """A row per document: doc_id, the counts, both distances, base_failed and kept."""
    rows, names = judged(documents)
    return rows.select(
        F.col(f"_d{names.index('doc_id')}").cast("long").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


def good_documents(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    rows, names = judged(documents)
    return rows.where("kept").select(*(F.col(f"_d{i}").alias(name) for i, name in enumerate(names)))
