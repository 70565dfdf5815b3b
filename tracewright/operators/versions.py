"""Release versions: newest patch per line, and pins against a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracewright.functions.text import minor_line, version_text

NEWER, UNLISTED, UNPINNED = "newer", "not listed", "not pinned"

# The sentence for each kind of difference.
SAYS_NEWER = "%s: pinned %s, upstream has %s"
SAYS_UNLISTED = "%s: pinned %s is not on the dist listing"
SAYS_UNPINNED = "%s: not pinned, upstream has %s"


def latest_patch_per_line(versions: DataFrame) -> DataFrame:
    """The highest patch of each (major, minor), lines ascending."""
    newest = versions.groupBy("major", "minor").agg(F.max("patch").alias("patch"))
    return newest.orderBy("major", "minor")


def version_drift(pinned: DataFrame, upstream: DataFrame) -> DataFrame:
    """Differences between pins (``line, pinned``) and upstream's versions
    (``major, minor, patch``): ``line, kind, pinned, upstream``.

    ``newer``: the line's newest upstream patch differs from the pin. ``not
    listed``: the pinned version is not upstream. ``not pinned``: an upstream
    line without a pin. A line can give two rows.
    """
    full = version_text("major", "minor", "patch")
    newest = (
        upstream.groupBy("major", "minor")
        .agg(F.max("patch").alias("patch"))
        .select(minor_line(full).alias("line"), full.alias("upstream"))
    )
    listed = upstream.select(full.alias("pinned")).distinct().withColumn("_listed", F.lit(True))
    compared = pinned.join(listed, "pinned", "left").join(newest, "line", "full_outer")
    kinds = F.array_compact(
        F.array(
            F.when(F.col("pinned").isNull(), UNPINNED),
            F.when(F.col("upstream") != F.col("pinned"), NEWER),
            F.when(F.col("pinned").isNotNull() & F.col("_listed").isNull(), UNLISTED),
        )
    )
    rows = compared.select("line", F.explode(kinds).alias("kind"), "pinned", "upstream")
    seen = F.when(F.col("kind") != UNLISTED, F.col("upstream"))
    return rows.withColumn("upstream", seen)


def drift_message(drift: DataFrame) -> DataFrame:
    """Add the drift as a sentence, ``message``."""
    message = (
        F.when(F.col("kind") == NEWER, F.format_string(SAYS_NEWER, "line", "pinned", "upstream"))
        .when(F.col("kind") == UNLISTED, F.format_string(SAYS_UNLISTED, "line", "pinned"))
        .otherwise(F.format_string(SAYS_UNPINNED, "line", "upstream"))
    )
    return drift.withColumn("message", message)
