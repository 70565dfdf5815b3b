"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm import (
    boilerplate,
    language,
    lattice,
    lexical,
    licences,
    minhash,
    pieces,
    preference,
    repetition,
    substrings,
    templates,
    toxicity,
    trie,
)
from tracewright.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_checked(table(spark, folder, "documents"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_repetition")
def op3_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.quality(table(spark, folder, "documents"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(fold("doc_id", 5) != 0))
    return language.with_held_out(language.predict(docs, model), folds=5, held=0)


@query("op10_minhash")
def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op7_preference_quality")
def op7_preference_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(fold("doc_id", 5) != 0)
    return language.with_held_out(preference.score(docs, preference.fit(docs, labels)), 5, 0)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(fold("doc_id", 4) != 2)
    return language.with_held_out(toxicity.score(docs, toxicity.fit(docs, labels)), 4, 2)


@query("op9_templates")
def op9_templates(spark: SparkSession, folder: str) -> DataFrame:
    return templates.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_licences", licences.oracle())
def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


_LINES_SQL = """
WITH line AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
trimmed AS (
  SELECT *, regexp_replace(line, '^[ \\t\\x0B\\f\\r]+|[ \\t\\x0B\\f\\r]+$', '', 'g') AS plain FROM line),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
seen AS (
  SELECT source, plain, count(DISTINCT doc_id) AS with_line FROM trimmed WHERE plain <> ''
  GROUP BY source, plain),
common AS (
  SELECT source, plain FROM seen JOIN pages USING (source)
  WHERE with_line >= 5 AND with_line > 0.1::DOUBLE * pages),
kept AS (
  SELECT t.doc_id, count(*) FILTER (WHERE c.plain IS NOT NULL) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.plain IS NULL), '') AS text
  FROM trimmed AS t LEFT JOIN common AS c ON t.source = c.source AND t.plain = c.plain
  GROUP BY t.doc_id)
SELECT doc_id, source, kept.text, n_dropped FROM documents JOIN kept USING (doc_id)
"""


@query("op6_boilerplate_lines", _LINES_SQL)
def op6_boilerplate_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return boilerplate.without_boilerplate(docs, docs["source"]).select(
        "doc_id", "source", "text", "n_dropped"
    )


@query("op11_trie", trie.oracle())
def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.trie(table(spark, folder, "conversations"))


@query("op12_lattice")
def op12_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


@query("op13_lexical", lexical.oracle())
def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
