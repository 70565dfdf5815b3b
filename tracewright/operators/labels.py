"""Scoring: the tags a run was designed to fire against the tags it fired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracewright.operators.catalog import SELF_GENERATED
from tracewright.sources.reports import fired_tags

# Analyzer exit codes that come with a full report, verdicts.
ACCEPTABLE_EXITS = (0, 3)
ALL_FIRED, TARGET_MISSED, UNCHECKED = 0, 1, 2

# The texts of errors and report lines.
LOG_NOT_FOUND = "log not found: "
CHECKSUM_DIFFERS = "checksum differs from catalog: "
STATUS_UNCHECKED, STATUS_MISSED, STATUS_OK = "UNCHECKED", "MISSED", "ok"
LINE_UNCHECKED = "UNCHECKED: %s: %s"
LINE_MISSED = "MISSED: %s: %s did not fire (fired: %s)"
LINE_OK = "ok: %s"
NOTHING_FIRED = "none"


def missing_targets(targets: str | Column, fired: str | Column) -> Column:
    """Targets that did not fire, in target order with repeats; null where the
    fired tags are unknown."""
    targets = F.col(targets) if isinstance(targets, str) else targets
    fired = F.col(fired) if isinstance(fired, str) else fired
    unfired = F.filter(targets, lambda tag: ~F.array_contains(fired, tag))
    return F.when(fired.isNotNull(), unfired)


def label_score(catalog: DataFrame, logs: DataFrame, reports: DataFrame) -> DataFrame:
    """Per self-generated entry: ``id, targets, fired, missing, error``.

    ``catalog`` has ``id, source, path, checksum, targets_detectors``; ``logs``
    the ``path, checksum`` of what is stored now; ``reports`` has ``id,
    exit_code, message, report``. The first failing check gives the error: log
    absent, checksum changed, analyzer failure, bad report. All three have
    one row per id or path.
    """
    entries = catalog.where(F.col("source").eqNullSafe(SELF_GENERATED)).select(
        "id", "path", "checksum", F.col("targets_detectors").alias("targets")
    )
    stored = logs.select("path", F.col("checksum").alias("_stored"))
    scored = fired_tags(reports).select(
        "id",
        F.lit(True).alias("_analyzed"),
        "exit_code",
        "message",
        F.col("fired").alias("_fired"),
        F.col("error").alias("_report_error"),
    )
    exit_error = F.concat(
        F.lit("analyzer exited "), F.col("exit_code").cast("string"), F.lit(": "), F.trim("message")
    )
    error = (
        F.when(F.col("_stored").isNull(), F.concat(F.lit(LOG_NOT_FOUND), "path"))
        .when(
            F.col("_stored") != F.col("checksum"),
            F.concat(F.lit(CHECKSUM_DIFFERS), "path"),
        )
        .when(F.col("_analyzed").isNull(), F.lit("no report"))
        .when(~F.col("exit_code").isin(*ACCEPTABLE_EXITS), exit_error)
        .otherwise(F.col("_report_error"))
    )
    joined = entries.join(stored, "path", "left").join(scored, "id", "left")
    checked = joined.withColumn("error", error).withColumn(
        "fired", F.when(F.col("error").isNull(), F.col("_fired"))
    )
    return checked.select(
        "id", "targets", "fired", missing_targets("targets", "fired").alias("missing"), "error"
    )


def score_against_findings(catalog: DataFrame, fired: DataFrame) -> DataFrame:
    """:func:`label_score` with tags from our own findings table (``id,
    fired``) in place of stored logs and reports."""
    entries = catalog.where(F.col("source").eqNullSafe(SELF_GENERATED))
    joined = entries.select("id", F.col("targets_detectors").alias("targets")).join(
        fired, "id", "left"
    )
    return joined.select(
        "id",
        "targets",
        "fired",
        missing_targets("targets", "fired").alias("missing"),
        F.when(F.col("fired").isNull(), F.concat(F.lit(LOG_NOT_FOUND), "id")).alias("error"),
    )


def status() -> Column:
    return (
        F.when(F.col("error").isNotNull(), STATUS_UNCHECKED)
        .when(F.size("missing") > 0, STATUS_MISSED)
        .otherwise(STATUS_OK)
    )


def label_report(scores: DataFrame) -> DataFrame:
    """One printable line per scored entry: ``id, line``."""
    fired = F.when(F.size("fired") > 0, F.array_join("fired", ", ")).otherwise(NOTHING_FIRED)
    missed = F.format_string(LINE_MISSED, "id", F.array_join("missing", ", "), fired)
    line = (
        F.when(F.col("error").isNotNull(), F.format_string(LINE_UNCHECKED, "id", "error"))
        .when(F.size("missing") > 0, missed)
        .otherwise(F.format_string(LINE_OK, "id"))
    )
    return scores.select("id", line.alias("line"))


def label_totals(scores: DataFrame) -> DataFrame:
    """Targeted tags that fired, of all targeted, over checked entries."""
    checked = scores.where(F.col("error").isNull())
    targeted = F.coalesce(F.sum(F.size("targets")), F.lit(0))
    missed = F.coalesce(F.sum(F.size("missing")), F.lit(0))
    return checked.agg((targeted - missed).alias("fired"), targeted.alias("targeted"))


def label_verdict(scores: DataFrame) -> DataFrame:
    """2 if any entry is unchecked, else 1 if any target was missed, else 0."""
    severity = (
        F.when(F.col("error").isNotNull(), UNCHECKED)
        .when(F.size("missing") > 0, TARGET_MISSED)
        .otherwise(ALL_FIRED)
    )
    return scores.agg(F.coalesce(F.max(severity), F.lit(ALL_FIRED)).cast("long").alias("verdict"))


def known_miss_reasons(entries: DataFrame) -> DataFrame:
    """Known misses as rows: ``id, tag, reason``."""
    return entries.select("id", F.explode("known_misses").alias("tag", "reason"))


def tag_coverage(entries: DataFrame) -> DataFrame:
    """Per tag: entries naming it as a target and as a known miss."""
    def named(tags: Column, kind: str) -> Column:
        return F.transform(F.array_distinct(tags), lambda t: F.struct(t.alias("tag"), F.lit(kind).alias("kind")))

    misses = F.coalesce(F.map_keys("known_misses"), F.array().cast("array<string>"))
    both = F.concat(named(F.col("targets_detectors"), "target"), named(misses, "miss"))
    tags = entries.select(F.explode(both).alias("t")).select("t.tag", "t.kind")
    return tags.groupBy("tag").agg(
        F.count_if(F.col("kind") == "target").alias("as_target"),
        F.count_if(F.col("kind") == "miss").alias("as_known_miss"),
    )


def known_miss_violations(entries: DataFrame) -> DataFrame:
    """Known misses that are also targets, or that give no reason."""
    misses = entries.select(
        "id", "targets_detectors", F.explode("known_misses").alias("tag", "reason")
    )
    problems = F.array_compact(
        F.array(
            F.when(F.array_contains("targets_detectors", F.col("tag")), "also a target"),
            F.when(F.trim(F.coalesce("reason", F.lit(""))) == "", "no reason"),
        )
    )
    return misses.select("id", "tag", F.explode(problems).alias("problem"))
