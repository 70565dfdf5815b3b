"""The corpus pipeline: documents that pass every text stage, as pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewright.llm import boilerplate, language, minhash, pieces, templates
from tracewright.llm.common import hold, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a likely language, go."""
    return language.identified(docs, language.fit(docs))


def without_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats on many documents go; all documents stay."""
    found = boilerplate.without_boilerplate(docs, docs["source"], count_col="__dropped")
    length = F.when(F.col("__dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.one_of_each_group(docs, width=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_skipped``: the pieces of every document."""
    return pieces.encode(docs)


STAGES = [
    ("language", known_language),
    ("lines", without_site_lines),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("pieces", as_pieces),
]

#: Piece segmentation and language models have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hold(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
