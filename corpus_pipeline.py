"""A training corpus from raw documents, by five of the operators in ``rowtide.llm``, one per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared
folder as Parquet and reads again for the next stage. A stage first deletes the intermediate tables of
those before it: its input is stored, so nothing reads them any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import decontaminate, mixing, quality, simhash, token_files
from rowtide.llm.queries import END_ID, tokenizer_path
from rowtide.llm.shared import prepare, release, stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    release(docs)
    return quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    release(docs)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    release(docs)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rate says."""
    release(docs)
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what a reader of them finds of each document."""
    release(docs)
    return token_files.token_files(docs, tokenizer_path(), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-id output", token_output),
]

#: Model fits, SimHash and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs)
    return docs
