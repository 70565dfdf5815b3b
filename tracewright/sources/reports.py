"""Analyzer reports and version listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracewright.functions.text import VERSION_ANCHOR, version_parts

NO_FINDINGS = "report has no findings list"
UNTAGGED = "finding without a tag"
NOT_JSON = "report is not valid JSON"


def _tag(finding: Column) -> Column:
    """A finding's tag if it is a non-empty string, else null."""
    tag = F.try_variant_get(finding, "$.tag", "variant")
    text = F.try_variant_get(finding, "$.tag", "string")
    return F.when((F.schema_of_variant(tag) == "STRING") & (text != ""), text)


def fired_tags(reports: DataFrame, report: str = "report") -> DataFrame:
    """Add ``fired`` (sorted distinct tags of the findings) and ``error``. Only
    findings count; clean checks do not."""
    parsed = reports.withColumn("_parsed", F.try_parse_json(report)).withColumn(
        "_tags",
        F.transform(F.try_variant_get("_parsed", "$.findings", "array<variant>"), _tag),
    )
    error = (
        F.when(F.col("_parsed").isNull(), NOT_JSON)
        .when(F.col("_tags").isNull(), NO_FINDINGS)
        .when(F.exists("_tags", lambda t: t.isNull()), UNTAGGED)
    )
    fired = F.when(error.isNull(), F.array_sort(F.array_distinct("_tags")))
    return parsed.withColumns({"fired": fired, "error": error}).drop("_parsed", "_tags")


def fired_tags_of_findings(findings: DataFrame) -> DataFrame:
    """The same from a findings table (``log_id, tag, fires``): ``id, fired``
    per log, an empty array where nothing fired."""
    tags = F.array_sort(F.collect_set(F.when(F.col("fires"), F.col("tag"))))
    return findings.groupBy(F.col("log_id").alias("id")).agg(tags.alias("fired"))


def extract_all(pages: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Every first-group match of ``pattern`` in ``text``, with its 1-based
    position in the page."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    kept = [c for c in pages.columns if c != text]
    return pages.select(*kept, F.posexplode(found).alias("pos", name)).withColumn(
        "pos", (F.col("pos") + 1).cast("long")
    )


def listed_versions(listings: DataFrame, text: str = "html", strict: bool = False) -> DataFrame:
    """Version triples named by a release listing's anchors. With ``strict`` a
    listing without any raises."""
    if strict:
        found = F.col(text).rlike(VERSION_ANCHOR)
        message = "no version directories found in the listing"
        listings = listings.withColumn(
            text, F.when(found, F.col(text)).otherwise(F.raise_error(F.lit(message)))
        )
    versions = extract_all(listings, text, VERSION_ANCHOR, "version")
    return versions.select("*", version_parts("version").alias("v")).select(
        *versions.columns, "v.major", "v.minor", "v.patch"
    )
