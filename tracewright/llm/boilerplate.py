"""Line dedup by site-relative frequency (operator 6); DataFrame functions only.

Texts are cut into lines at ``\\n``. For each host, the pages containing a line are
divided by all pages of the host, and a line whose share exceeds ``RATIO`` on at
least ``LEAST_PAGES`` pages is boilerplate of that host and dropped from its pages.
Lines are compared without surrounding white space; blank lines stay.

A line counts once a page. Boilerplate lines of one host are few: each takes up more
than ``RATIO`` of its pages, so there are at most (mean lines a page) / ``RATIO`` of
them, however many pages the host has. They are held as one array per host, written
out first, so that Spark broadcasts them only if their size on disk allows it and
splits a hot host by its skew join otherwise.

Defined results: a null text stays null and has no lines; a null host is a host of
its own, whose pages are compared with each other. A text all of whose lines are
dropped becomes empty. Repeated rows are pages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracewright.llm.common import fresh, hold

RATIO = 0.1
LEAST_PAGES = 5


def trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[ \t\x0B\f\r]+|[ \t\x0B\f\r]+$", "")


def boilerplate(
    pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least: int = LEAST_PAGES
) -> DataFrame:
    """``host, lines array<string>``: the boilerplate lines of each host that has any."""
    rows = pages.select(F.coalesce(host, F.lit("")).alias("host"), host.isNull().alias("none"), text.alias("text"))
    totals = rows.groupBy("host", "none").agg(F.count("*").alias("pages"))
    lines = F.array_distinct(F.transform(F.split("text", "\n"), trimmed))
    seen = (
        rows.select("host", "none", F.explode(lines).alias("line"))
        .where("line <> ''")
        .groupBy("host", "none", "line")
        .agg(F.count("*").alias("with_line"))
        .where(F.col("with_line") >= least)
    )
    frequent = seen.join(totals, ["host", "none"]).where(F.col("with_line") > ratio * F.col("pages"))
    return frequent.groupBy("host", "none").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def without_boilerplate(
    pages: DataFrame,
    host: Column,
    text_col: str = "text",
    ratio: float = RATIO,
    least: int = LEAST_PAGES,
    count_col: str = "n_dropped",
) -> DataFrame:
    """``pages`` with ``text_col`` reduced and ``count_col long``, the lines dropped,
    which replaces a column of that name."""
    found = hold(boilerplate(pages, host, pages[text_col], ratio, least), "boilerplate")
    host_name, lines_name = fresh(pages.columns, "host"), fresh(pages.columns, "lines")
    found = found.select(
        F.when(~F.col("none"), F.col("host")).alias(host_name), F.col("lines").alias(lines_name)
    )
    joined = pages.join(found, host.eqNullSafe(found[host_name]), "left")
    text, common = pages[text_col], F.col(lines_name)
    all_lines = F.split(text, "\n")
    kept = F.filter(all_lines, lambda line: ~F.array_contains(common, trimmed(line)))
    some = common.isNotNull() & text.isNotNull()
    dropped = F.when(some, F.size(all_lines) - F.size(kept)).otherwise(0).cast("long")
    return joined.select(
        *[
            F.when(some, F.array_join(kept, "\n")).otherwise(text).alias(c) if c == text_col else pages[c]
            for c in pages.columns
            if c != count_col
        ],
        dropped.alias(count_col),
    )
