"""Secret scan with a random forest that removes false positives (operator 4), in DataFrame and ML functions only.

A word is cut into pieces of key characters and pieces of others, so that names, signs, quotes and
values stand apart in JSON, links, CSV and logs. Every run of key characters is a candidate that
holds a digit, changes case inside, or is given to a secret's name. Each is described by its length,
the changes between its character classes, how much of its letters words of the dictionary cover,
whether it looks like a path or an address, and what the pieces or words beside it say. The dictionary
is the words that most documents have. A random forest, trained on labelled findings, gives the
probability that a candidate is a secret.

The words of a document stay in its row, and the pieces of a word in the word's; only candidates
become rows. Neighbours are looked at for the nearest ``NEAR`` characters, so the work is linear in the
text, also where it is one word.

Labelled findings are a table doc_id, place, run, is_secret; without the column run, a label holds
for every run of its word. Where there is none, ``seed_findings`` labels
those whose form decides alone or together with the words before: vendor prefixes with a fixed length
and assignments to a secret's name against card numbers, mail and network addresses, links and plain
hyphenated words. They are seeds; the forest sees none of those rules, and judges the rest.

Nulls and ties: a null text has no words. Documents without an id are scanned like others, but
cannot be labelled. Repeated rows give repeated findings. Findings that are labelled twice count as
secret if one label says so. Without labels of both kinds no candidate is removed and the score is
null. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.shared import prepare, stage

#: Characters of a candidate's run at least.
LEAST = 8
#: Characters of the pieces and words beside a candidate that are looked at, the nearest ones.
NEAR = 64
#: Labelled findings the forest is trained on at most, those of least hash; and its size.
SAMPLE, TREES, DEPTH = 8_000, 24, 8
#: Words that make the dictionary, and their letters.
DICTIONARY, WORD_LETTERS = 4_000, (3, 24)
#: Score from which a candidate is a secret.
THRESHOLD = 0.5

# The characters of keys, and the names that secrets are given.
_KEY = r"A-Za-z0-9+/_\-.~@"
_RUN = rf"[{_KEY}]{{{LEAST},}}"
_PIECE = rf"[{_KEY}]++|[^{_KEY}]++"
_HOLDS = r"(?s)[0-9]|[a-z][A-Z].*[a-z][A-Z]"
_NAMED = r"(?i)(token|secret|passw(or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private)"
_ASSIGNS = r"[=:][^A-Za-z0-9]*$"
_GIVEN = rf"{_NAMED}[^=:]*{_ASSIGNS}"
_VENDOR = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\."
_PLAIN = r"^[0-9]{12,19}$|^[^@]+@[^@]+\.[A-Za-z]{2,}$|^[0-9]{1,3}(\.[0-9]{1,3}){3}$|^//|^[a-z]+(-[a-z]+)+$"

FEATURES = (
    "length", "digit_share", "upper_share", "letter_share", "changes", "change_share", "fresh_share", "hex_only", "digits_only",
    "coverage", "slashes", "dots", "at_sign", "assigned", "before_named", "before_assigns", "before_length", "after_length",
    "before_coverage", "after_coverage",
)


def common_words(documents: DataFrame) -> list[str]:
    """The words that most documents of the corpus have; at most DICTIONARY come to the driver."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[^\p{L}]+"))
    long_enough = documents.select(F.explode(F.filter(words, lambda w: F.length(w).between(*WORD_LETTERS))).alias("word"))
    counts = long_enough.groupBy("word").count().orderBy(F.desc("count"), "word").limit(DICTIONARY)
    return [row.word for row in counts.collect()]


def _end(value: Column) -> Column:
    return F.right(F.coalesce(value, F.lit("")), F.lit(NEAR))


def _start(value: Column) -> Column:
    return F.left(F.coalesce(value, F.lit("")), F.lit(NEAR))


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id, place (of the word), run (of the piece), before2, before, mark, after and candidate.

    before2, before and after are pieces of the word, or the words beside it; mark is the signs and
    quotes right in front of the candidate.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # Most texts have no such run; they are not cut into words.
    rows = rows.where(F.col("text").rlike(_RUN) & (F.col("text").rlike(_HOLDS) | F.col("text").rlike(_NAMED)))
    rows = rows.select("doc_id", F.split("text", r"[ \t\n\x0B\f\r]+").alias("words"))
    word = lambda i: F.get("words", i)
    named = lambda i: word(i).rlike(_NAMED) | _end(word(i - 1)).rlike(_NAMED) | _end(word(i - 2)).rlike(_NAMED)
    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (F.length(word(i)) >= LEAST) & word(i).rlike(_RUN) & (word(i).rlike(_HOLDS) | named(i)),
    )
    found = F.transform(
        places,
        lambda i: F.struct(
            i.alias("place"), _end(word(i - 2)).alias("word2"), _end(word(i - 1)).alias("word1"), _start(word(i + 1)).alias("next"),
            word(i).alias("word"),
        ),
    )
    rows = rows.select("doc_id", F.explode(found).alias("at")).select("doc_id", "at.*")
    rows = rows.withColumn("pieces", F.regexp_extract_all("word", F.lit(_PIECE), F.lit(0))).drop("word")
    piece = lambda i: F.get("pieces", i)
    runs = F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), lambda i: (F.length(piece(i)) >= LEAST) & piece(i).rlike(_RUN))
    found = F.transform(
        runs,
        lambda i: F.struct(
            i.alias("run"),
            F.when(i >= 2, F.col("word1")).otherwise(F.col("word2")).alias("before2"),
            F.when(i >= 2, _end(piece(i - 2))).otherwise(F.col("word1")).alias("before"),
            _end(piece(i - 1)).alias("mark"),
            F.when(i + 2 < F.size("pieces"), _start(piece(i + 2))).otherwise(F.col("next")).alias("after"),
            F.rtrim(piece(i), F.lit(".")).alias("candidate"),
        ),
    )
    rows = rows.select("doc_id", "place", F.explode(found).alias("at")).select("doc_id", "place", "at.*")
    return rows.where((F.length("candidate") >= LEAST) & (F.col("candidate").rlike(_HOLDS) | _before().rlike(_GIVEN)))


def _before() -> Column:
    """What stands in front of the candidate."""
    return F.concat("before2", F.lit(" "), "before", "mark")


def _coverage(name: str, dictionary: list[str]) -> Column:
    """Share of the letters that are in words of the dictionary; a change to capitals begins a word."""
    if not dictionary:
        return F.lit(0.0)
    words = ", ".join(f"'{word}'" for word in dictionary)  # letters only
    known = F.expr(
        f"array_join(filter(transform(regexp_extract_all({name}, r'\\p{{Lu}}?\\p{{Ll}}+|\\p{{Lu}}+', 0), p -> lower(p)), p -> p in ({words})), '')"
    )
    letters = F.length(F.regexp_replace(name, r"[^\p{L}]", ""))
    return F.when(letters > 0, F.length(known) / letters).otherwise(0.0)


def described(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """The candidates with their features."""
    word = F.col("candidate")
    n = F.greatest(F.lit(1), F.length(word))
    classes = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(word, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A"), "[^0aA]", "-"
    )
    runs = F.size(F.regexp_extract_all(classes, F.lit(r"(0+|a+|A+|-+)")))
    count = lambda pattern: F.regexp_count(word, F.lit(pattern)).cast("double")
    flag = lambda condition: condition.cast("double")
    columns = {
        "length": F.length(word).cast("double"),
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "letter_share": count("[A-Za-z]") / n,
        "changes": (runs - 1).cast("double"),
        "change_share": (runs - 1) / n,
        "fresh_share": F.size(F.array_distinct(F.split(word, ""))) / n,
        "hex_only": flag(word.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "digits_only": flag(word.rlike("^[0-9]+$")),
        "coverage": _coverage("candidate", dictionary),
        "slashes": count("/"),
        "dots": count(r"\."),
        "at_sign": count("@"),
        "assigned": flag(_before().rlike(_GIVEN)),
        "before_named": flag(F.concat_ws(" ", "before2", "before").rlike(_NAMED)),
        "before_assigns": flag(F.concat("before", "mark").rlike(_ASSIGNS)),
        "before_length": F.length("before").cast("double"),
        "after_length": F.length("after").cast("double"),
        "before_coverage": _coverage("before", dictionary),
        "after_coverage": _coverage("after", dictionary),
    }
    return found.withColumns(columns)


def seed_findings(found: DataFrame) -> DataFrame:
    """doc_id, place, run, is_secret of the candidates whose form decides."""
    given = _before().rlike(_GIVEN)
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]") & (F.length("candidate") >= 16)
    secret = F.col("candidate").rlike(_VENDOR) | (given & mixed)
    plain = F.col("candidate").rlike(_PLAIN) & ~given
    return found.where("doc_id is not null").where(secret | plain).select("doc_id", "place", "run", secret.alias("is_secret"))


def sampled_labels(labelled: DataFrame) -> tuple[DataFrame, list[str]]:
    """The labels of least hash, SAMPLE at most, and the columns they are known by.

    Rows far from the least are left out before they are ordered, which changes nothing of the sample.
    """
    kinds = {"doc_id": "long", "place": "int", "run": "int"}
    keys = [name for name in kinds if name in labelled.columns]
    labels = labelled.select(*(F.col(name).cast(kinds[name]) for name in keys), F.col("is_secret").cast("int"))
    labels = labels.groupBy(*keys).agg(F.max("is_secret").cast("double").alias("label")).where("label is not null and doc_id is not null")
    labels = stage(labels)
    order, n = F.xxhash64(*keys), labels.count()
    if n > 2 * SAMPLE:
        labels = labels.where(order < F.lit((1 << 65) * SAMPLE // n - (1 << 63)))
    return stage(labels.orderBy(order, *keys).limit(SAMPLE)), keys


def secret_findings(documents: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, place, run, shown (its ends), sha256, length, coverage, score and is_secret of every candidate."""
    prepare(documents.sparkSession)
    found = stage(described(candidates(documents), common_words(documents)))
    labels, keys = sampled_labels(seed_findings(found) if labelled is None else labelled)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(found)
    sample = stage(rows.join(labels, keys).select("doc_id", "place", "run", "label", "_features"))
    if sample.select("label").distinct().count() < 2:
        scored = rows.withColumn("score", F.lit(None).cast("double"))
    else:
        forest = RandomForestClassifier(featuresCol="_features", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=3, seed=11)
        model = forest.fit(sample.repartition(4, "doc_id", "place").sortWithinPartitions("doc_id", "place", "run"))
        model = model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_shares")
        scored = model.transform(rows).withColumn("score", F.round(vector_to_array("_shares")[1], 6))
    word = F.col("candidate")
    return scored.select(
        "doc_id", "place", "run", F.concat(F.left(word, F.lit(3)), F.lit("..."), F.right(word, F.lit(2))).alias("shown"),
        F.sha2(word, 256).alias("sha256"), F.length(word).alias("length"), F.round("coverage", 6).alias("coverage"), "score",
        F.coalesce(F.col("score") >= THRESHOLD, F.lit(True)).alias("is_secret"),
    )
