"""Mixing domains to target weights by soft membership (operator 5), in DataFrame and ML functions only.

A multinomial classifier, fitted on a bounded sample of the labelled documents, gives every document
posteriors of its domain. Nonnegative document rates r are then fitted so that the expected tokens
of each domain, the sum of r x tokens x posterior, come as near to the targets as they can in least
squares, by projected gradient from r = 1:

    r <- max(0, r - posterior . W (totals(r) - targets))

The squares are weighted by W, the damped inverse of the posteriors' second moments, under which a
step of 1 is safe and a few steps are enough; targets that can be met are met under any weights.

Only the totals, one number per domain, come to the driver; the rates are never stored, as they
follow from the few gradients so far. The rate becomes copies by rounding up with the probability
of its fraction, decided by a hash.

Nulls and ties: a null text has no tokens; its rate has no effect on totals and is fitted like
others. Labels without an id or without either label are not used; several labels of a document
count as the worst of each. Rows that repeat a document are each fitted and rounded alike. Without
labels of two domains at least every document has the first domain. Own columns pass through
``mixed_documents`` untouched. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.shared import prepare, stage

DOMAINS = ("good", "poor", "toxic")
#: Targets in parts of the tokens that the first domain is expected to have.
TARGETS = {"good": 1.1, "poor": 0.06, "toxic": 0.02}
#: Labelled documents the classifier is fitted on at most: those of least hash.
SAMPLE = 8_000
WORD_FEATURES = 1 << 14
#: Steps at most; the fit ends when totals move, or miss their targets, by less than so much of all tokens.
STEPS, TOLERANCE, NEAR, DAMPING = 40, 1e-5, 2e-4, 0.01
_SHARES = ("upper", "symbols", "fresh", "length")


def domain_labels(labels: DataFrame) -> DataFrame:
    """doc_id and the index of its domain, for a bounded sample of the labelled documents."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), F.col("toxic").cast("int"))
    known = known.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return known.select("doc_id", domain.cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)


def featured(documents: DataFrame) -> DataFrame:
    """Adds n_tokens and features: hashed words, and shares that depend on no word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), "")
    rows = documents.withColumn("_words", words).withColumn("n_tokens", F.size("_words").cast("long"))
    rows = rows.withColumn("_distinct", F.array_distinct("_words"))
    chars = F.greatest(F.lit(1), F.length(text))
    rows = rows.withColumns(
        {
            "_upper": F.regexp_count(text, F.lit(r"\p{Lu}")) / chars,
            "_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>!]")) / chars,
            "_fresh": F.size("_distinct") / F.greatest(F.lit(1), F.size("_words")),
            "_length": F.log1p(F.size("_words")) / 10,
        }
    )
    rows = HashingTF(numFeatures=WORD_FEATURES, binary=True, inputCol="_distinct", outputCol="_hashed").transform(rows)
    names = [f"_{name}" for name in _SHARES]
    rows = VectorAssembler(inputCols=[*names, "_hashed"], outputCol="_features").transform(rows)
    return rows.drop("_words", "_distinct", "_hashed", *names)


def posteriors(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with n_tokens and _p0, _p1, ... of the domains, written to the shared folder.

    The sample has SAMPLE rows at most, which is why it may be broadcast.
    """
    sample = stage(domain_labels(labels))
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    known = stage(known)
    rows = featured(documents)
    seen = sorted(int(r.label) for r in known.select("label").distinct().collect())
    if len(seen) < 2:
        only = seen[0] if seen else 0
        shares = [F.lit(float(k == only)) for k in range(len(DOMAINS))]
    else:
        learner = LogisticRegression(featuresCol="_features", family="multinomial", maxIter=40, regParam=0.02)
        model = learner.fit(featured(known.select("label", "text")).select("label", "_features").coalesce(8))
        rows = model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_shares").transform(rows)
        rows = rows.withColumn("_list", vector_to_array("_shares"))
        shares = [F.col("_list")[k] if k in seen else F.lit(0.0) for k in range(len(DOMAINS))]
    rows = rows.withColumns({f"_p{k}": share for k, share in enumerate(shares)})
    return stage(rows.drop("_features", "_shares", "_list"))


def rate_after(gradients: list[np.ndarray]) -> Column:
    """The document's rate after the gradients so far: one fold over them, the same code at any step."""
    steps = F.array(*(F.array(*(F.lit(float(g)) for g in gradient)) for gradient in gradients))
    along = lambda g: sum((F.col(f"_p{k}") * g[k] for k in range(len(DOMAINS))), F.lit(0.0))
    return F.aggregate(steps, F.lit(1.0), lambda rate, g: F.greatest(F.lit(0.0), rate - along(g)))


def fitted_rate(rows: DataFrame, targets: dict[str, float]) -> tuple[Column, list[dict]]:
    """The rate as an expression of the posteriors, and the totals of every step."""
    k = len(DOMAINS)
    shares = [F.col(f"_p{i}") for i in range(k)]
    weight = F.col("n_tokens").cast("double")
    first = rows.agg(
        F.sum(weight).alias("all"),
        *(F.sum(weight * shares[i]).alias(f"a{i}") for i in range(k)),
        *(F.sum(weight * shares[i] * shares[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(k)),
    ).first()
    if not first["all"]:
        return F.lit(1.0), []
    total = first["all"]
    wanted = np.array([targets[name] for name in DOMAINS]) * first["a0"] / total
    gram = np.array([[first[f"m{i}_{j}"] for j in range(k)] for i in range(k)]) / total
    damped = np.linalg.inv(gram + DAMPING * max(np.linalg.eigvalsh(gram).max(), 1e-9) * np.eye(k))
    have, gradients, steps = np.array([first[f"a{i}"] for i in range(k)]) / total, [], []
    for _ in range(STEPS):
        steps.append({"totals": (have * total).tolist(), "targets": (wanted * total).tolist()})
        gradients.append(damped @ (have - wanted))
        rate = rate_after(gradients)
        sums = rows.agg(*(F.sum(weight * shares[i] * rate).alias(f"a{i}") for i in range(k))).first()
        new = np.array([sums[i] for i in range(k)]) / total
        moved, have = np.abs(new - have).max(), new
        if moved < TOLERANCE or np.abs(have - wanted).max() < NEAR:
            break
    steps.append({"totals": (have * total).tolist(), "targets": (wanted * total).tolist()})
    return rate_after(gradients), steps


def _rounded(rate: Column, doc_id: Column) -> Column:
    part = F.pmod(F.xxhash64(F.lit("copies"), doc_id), F.lit(1 << 20)) / float(1 << 20)
    return F.floor(rate + part).cast("int")


def _renamed(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """Own columns as _d0, _d1, ..., beside the id and text that are read, so that no name clashes."""
    names = documents.columns
    kept = documents.toDF(*(f"_d{i}" for i in range(len(names))))
    doc_id, text = (F.col(f"_d{names.index(c)}") for c in ("doc_id", "text"))
    return kept.withColumn("doc_id", doc_id.cast("long")).withColumn("text", text.cast("string")), names


def mixing_rates(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, the posterior of every domain, rate and copies of every document."""
    prepare(documents.sparkSession)
    rows = posteriors(documents.select("doc_id", "text"), labels)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    rate, _ = fitted_rate(rows, targets or TARGETS)
    rows = rows.withColumn("rate", rate)
    return rows.select(
        "doc_id", "n_tokens", *(F.round(f"_p{k}", 6).alias(f"p_{name}") for k, name in enumerate(DOMAINS)),
        F.round("rate", 6).alias("rate"), _rounded(F.col("rate"), F.col("doc_id")).alias("copies"),
    )


def mixed_documents(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Every document as often as its copies, with its own columns."""
    prepare(documents.sparkSession)
    own, names = _renamed(documents)
    rows = posteriors(own, labels)
    rate, _ = fitted_rate(rows, targets or TARGETS)
    rows = rows.withColumn("_copies", _rounded(rate, F.col("doc_id"))).where("_copies > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(*(F.col(f"_d{i}").alias(name) for i, name in enumerate(names)))
