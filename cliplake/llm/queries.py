"""The registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, forest_join, html_text, langid, lattice, lines, mixing, pii, quality, ranking, secret_scan, spans, whitening
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.new_ledger(spark)))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines.dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("total_lines").cast("long").alias("n_lines"), F.size("removed_lines").cast("long").alias("n_removed"), F.array_join(F.transform("removed_lines", lambda x: x.cast("string")), ",").alias("removed"), "text")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", *quality.BASE, "base_failed", "kept", "score")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(table(spark, sf_dir, "documents")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.check(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_lattice_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in sorted(globals().items()) if k.startswith("op") and callable(v)}
