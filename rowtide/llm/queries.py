"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import (
    chat, decontaminate, html_text, mixing, passages, periods, quality, secrets, simhash, spelling, substrings, token_files, warc,
)
from rowtide.llm.shared import table

END_ID = 2


def tokenizer_path() -> str:
    """The public vocabulary file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_conversations(table(spark, sf_dir, "conversations"))


def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_findings(table(spark, sf_dir, "documents"))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_template_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op7_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op10_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeated_windows(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(periods.with_planted_runs(table(spark, sf_dir, "documents")))
    found = found.withColumn("top", periods.greatest_run(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        periods.runs_digest(F.col("runs")).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), damaged=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_simhash_components, op2_chat_snapshots, op3_divergence_rules, op4_secret_forest, op5_soft_mixing,
        op6_template_classes, op7_benchmark_windows, op8_token_files, op9_repeated_substrings, op10_warc_ranges,
        op11_repeated_windows, op12_periodic_runs, op13_spelling_variants,
    )
}
