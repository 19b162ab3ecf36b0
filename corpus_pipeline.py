"""Training-corpus pipeline: five stages of the llm operators over `documents`.

All stages take and keep rows with nulls, repeated rows, texts of any length and
columns of any name; an empty table stays empty. What each does with them is in
its docstring and in that of its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cliplake.llm import decontam, forest_join, lines, mixing, quality
from cliplake.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, those with a null, empty or blank text among them (they have no words); copies are judged alike."""
    return quality.reject(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document whose lines all go, goes; n_chars follows the text. The first by (doc_id, line) stays, null ids come last; a document without text has no lines to lose and stays."""
    return lines.keep(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of Jaccard similarity 0.8 or more, the one with the least doc_id stays; of rows that agree in id and text, one. Documents without words all stay."""
    return forest_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go. A null or empty text, or an empty benchmark, holds none; copies get the same verdict."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: a row each. A null text has size 0 and gives nothing; null sources are one source, the last."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard),
    ("benchmark_decontamination", decontamination),
    ("mixing_to_target_weights", mixing_sources),
]

#: The isolation forest is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
