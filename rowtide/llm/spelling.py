"""Groups of spelling variants, by a dictionary of pairs of trie nodes (operator 13).

Two words are near if one inserted, deleted or replaced code point makes one of the other. Either way
they share what stands before that place and what stands behind it: a node of the trie of all words
and a node of the trie of all reversed words.

1. Words are counted within tasks, then over all, sorted and numbered in code-point order.
2. The nodes of a trie are numbered on one pass over sorted words: a word has the nodes of the word
   before it as deep as both agree, and new ones below. Nodes on the path of the first or last word of
   a partition may go on in the next one, so their number is a hash of their text; all others are
   (partition, counter). Nodes that no second word can have are left out.
3. Every word gives a pair of nodes (before, behind) per skipped code point, and one per place where a
   code point may be inserted. Words that share a pair differ in the skipped one, or in the inserted one.
   The place of a deletion inside a run of one letter is that of the run's first letter, so that every
   near word is met once.
4. A pair holds one word per letter at most, and one more for the inserted place, however large the
   vocabulary is; every word takes the number of its near words there, and the best of them.

Forms are followed to the last by doubling: each is at least ``ratio`` times as frequent as the one
before, so the steps are few.

Nulls and ties: a null text has no words, and words count by all rows, repeated ones included. Among
near words of the same count the first in code-point order is the form. Other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.shared import prepare, stage

LENGTH = 7
TIMES = 2
RATIO = 10
#: One of so many runs loses a code point, where runs are to be damaged.
DAMAGED = 31
#: Different words that a task counts before it gives its sums.
COUNTED = 400_000
#: Steps of doubling; more than any chain of growing 64-bit counts needs.
_DOUBLINGS = 6


def word_counts(documents: DataFrame, length: int = LENGTH, damaged: bool = False) -> DataFrame:
    """word, n: maximal runs of Latin letters, A-Z in lower case, of at least ``length`` code points.

    With ``damaged`` a run of text d loses the code point h % its length, where h is the CRC-32 of
    ``d:run``, if 31 divides h. Runs of rows without an id stay whole.
    """
    runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{length},}}")

    def counted(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
        found = " ".join(runs.findall(text)).encode("latin-1").lower()  # of bytes, lower() changes A-Z alone
        times = Counter(found.split(b" ")) if found else {}
        if not damaged or doc_id is None:
            yield from times.items()
            return
        begin = zlib.crc32(b"%d:" % doc_id)
        for word, n in times.items():
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begin)
            if h % DAMAGED == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < length:
                    continue
            yield word, n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def sums() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in counted(doc_id, text.as_py() or ""):
                    total[word] = total.get(word, 0) + n
                if len(total) >= COUNTED:
                    yield sums()
                    total = {}
        yield sums()

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = chosen.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _agreeing(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b)):  # noqa: B905
        if x != y:
            return i
    return min(len(a), len(b))


def _path_hashes(word: str) -> list[int]:
    """A negative number for every prefix."""
    state, out = xxhash.xxh3_64(), [0]
    for letter in word:
        state.update(letter.encode())
        out.append(-1 - (state.intdigest() >> 1))
    return out


def trie_nodes(words: DataFrame) -> DataFrame:
    """id, nodes, fresh for every (id, word): the numbers of its nodes that other words may have, root first.

    ``fresh`` says of each of these places whether the letter there differs from the one before.
    """
    schema = pa.schema([("id", pa.int64()), ("nodes", pa.list_(pa.int64())), ("fresh", pa.list_(pa.bool_()))])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
        if not texts:
            return
        first, last = _path_hashes(texts[0]), _path_hashes(texts[-1])
        new = TaskContext.get().partitionId() << 40
        path, before, out = [0], 0, []
        for k, (own, word) in enumerate(zip(ids, texts, strict=True)):
            after = _agreeing(word, texts[k + 1]) if k + 1 < len(texts) else 0
            with_first, with_last = _agreeing(word, texts[0]), _agreeing(word, texts[-1])
            path = path[: before + 1]
            for depth in range(before + 1, max(after, with_first, with_last) + 1):
                if depth <= with_first:
                    path.append(first[depth])
                elif depth <= with_last:
                    path.append(last[depth])
                else:
                    new += 1
                    path.append(new)
            out.append((own, list(path), [i == 0 or word[i - 1 : i] != word[i : i + 1] for i in range(len(path))]))
            before = after
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema=schema)

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = words.select("id", "word").repartitionByRange(parts, "word").sortWithinPartitions("word")
    return placed.mapInArrow(number, "id long, nodes array<long>, fresh array<boolean>")


def node_pairs(words: DataFrame) -> DataFrame:
    """before, behind, gap, entry for the places of all (id, word, n): pairs that another word may have.

    ``gap`` tells places between code points from skipped ones; entry is (rank, id, fresh), the word
    with its negative count first, so that the least entry is the most frequent word.
    """
    forward = stage(trie_nodes(words))
    reverse = trie_nodes(words.select("id", F.reverse("word").alias("word")))
    reverse = stage(reverse.select("id", F.col("nodes").alias("ends")))
    rows = words.select("id", "n", F.length("word").alias("size")).join(forward, "id").join(reverse, "id")

    def places(gap: bool) -> DataFrame:
        """The nodes before and behind each place that are both there."""
        left = F.col("size") - (0 if gap else 1)
        low = F.greatest(F.lit(0), left - F.size("ends") + 1)
        high = F.least(F.size("nodes") - 1, left)

        def pair(i: Column) -> Column:
            return F.struct(
                F.get("nodes", i).alias("before"), F.get("ends", left - i).alias("behind"),
                F.get("fresh", i).alias("fresh"),
            )

        found = rows.select("id", "n", F.explode(F.when(low <= high, F.transform(F.sequence(low, high), pair))).alias("p"))
        entry = F.struct((-F.col("n")).alias("rank"), "id", F.col("p.fresh").alias("fresh"))
        return found.select("p.before", "p.behind", F.lit(gap).alias("gap"), entry.alias("entry"))

    return places(False).unionByName(places(True))


def near_words(words: DataFrame) -> DataFrame:
    """id, n_near and best (rank, id) of all words (id, word, n) that have a near word."""
    pairs = node_pairs(words).groupBy("before", "behind").agg(
        F.sort_array(F.collect_list(F.when(~F.col("gap"), F.col("entry")))).alias("skips"),
        F.max(F.when(F.col("gap"), F.col("entry"))).alias("whole"),
    )
    pairs = pairs.where("size(skips) > 1 or (size(skips) = 1 and whole is not null)")
    plain = lambda e: F.when(e.isNotNull(), F.struct(e["rank"].alias("rank"), e["id"].alias("id")))
    skips, whole = F.col("skips"), F.col("whole")

    def of_skip(e: Column) -> Column:
        """The others that lack this place, and the word that lacks it as a whole."""
        other = F.when(F.get(skips, F.lit(0))["id"] == e["id"], F.get(skips, F.lit(1))).otherwise(F.get(skips, F.lit(0)))
        shorter = F.when(e["fresh"], whole)
        n = F.size(skips) - 1 + shorter.isNotNull().cast("int")
        best = F.array_min(F.filter(F.array(plain(other), plain(shorter)), lambda x: x.isNotNull()))
        return F.struct(e["id"].alias("id"), n.alias("n"), best.alias("best"))

    longer = F.filter(skips, lambda e: e["fresh"])
    of_whole = F.struct(whole["id"].alias("id"), F.size(longer).alias("n"), plain(F.get(longer, F.lit(0))).alias("best"))
    met = F.concat(F.transform(skips, of_skip), F.when(whole.isNotNull(), F.array(of_whole)).otherwise(F.array()))
    found = pairs.select(F.explode(met).alias("m")).where("m.n > 0").select("m.*")
    return found.groupBy("id").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """id, root for every (id, up) by following ``up`` to the last."""
    roots = stage(forms.select("id", F.col("up").alias("root")))
    for _ in range(_DOUBLINGS):
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        joined = stage(roots.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), "next"))
        roots = joined.select("id", "root")
        if joined.where("next is not null").isEmpty():
            break
    return roots


def variant_groups(counts: DataFrame, times: int = TIMES, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words (word, n) that occur at least ``times``.

    The form is the near word of largest count, if that is ``ratio`` times the word's own; the root is
    the last of the forms from there on, or the word itself.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than the word")
    words = stage(counts.where(F.col("n") >= times))
    words = stage(words.orderBy("word").withColumn("id", F.monotonically_increasing_id()))
    near = stage(near_words(words))
    known = words.join(near, "id", "left")
    holds = -F.col("best.rank") >= ratio * F.col("n")
    known = stage(
        known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                     F.when(holds, F.col("best.id")).alias("up"), F.when(holds, -F.col("best.rank")).alias("form_n"))
    )
    roots = followed(known.where("up is not null").select("id", "up"))
    named = words.select(F.col("id").alias("up"), F.col("word").alias("form"))
    last = words.select(F.col("id").alias("root_id"), F.col("word").alias("root_word"))
    out = known.join(roots.withColumnRenamed("root", "root_id"), "id", "left").join(named, "up", "left")
    out = out.join(last, "root_id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    documents: DataFrame, length: int = LENGTH, times: int = TIMES, ratio: int = RATIO, damaged: bool = False
) -> DataFrame:
    """The variant groups of the words of all texts."""
    prepare(documents.sparkSession)
    return variant_groups(word_counts(documents, length, damaged), times, ratio)
