"""Column expressions over log text, paths, tags and versions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters str.strip() removes, the codec suffixes, and
# the patterns of rolled file names, tags and listing anchors.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)
CODECS = ("zstd", "lz4", "snappy")
CODEC_SUFFIX = r"[^/]\.(zstd|lz4|snappy)$"
ROLLED_NAME = r"^events_([0-9]+)_.+$"
MARKER_PREFIX = "appstatus_"
TAG = r"^v[0-9]{4}-[0-9]{2}-[0-9]{2}$"
VERSION_ANCHOR = r'href="spark-([0-9]+\.[0-9]+\.[0-9]+)/"'


def col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def stripped(line: str | Column) -> Column:
    return F.btrim(col(line), F.lit(WHITESPACE))


def codec_of(path: str | Column) -> Column:
    """The codec a path's suffix names, else ``none``."""
    found = F.regexp_extract(col(path), CODEC_SUFFIX, 1)
    return F.when(found == "", "none").otherwise(found)


def base_name(path: str | Column) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(path: str | Column) -> Column:
    """The file name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(base_name(path), r"(?<=[^/])\.[^.]+$", "")


def path_parts(path: str | Column) -> Column:
    """Path components; ordering by them puts ``a/b`` before ``a-b``."""
    return F.split(col(path), "/")


def minor_line(version: str | Column) -> Column:
    """``a.b`` of ``a.b.c``."""
    return F.substring_index(col(version), ".", 2)


def version_parts(version: str | Column) -> Column:
    """``a.b.c`` as a struct, which compares like the version does; a part that is
    absent or no 64-bit number is null."""
    parts = F.split(col(version), r"\.")
    return F.struct(
        *[
            F.get(parts, F.lit(i)).try_cast("long").alias(n)
            for i, n in enumerate(("major", "minor", "patch"))
        ]
    )


def version_text(major: str | Column, minor: str | Column, patch: str | Column) -> Column:
    return F.concat_ws(".", *[col(c).cast("string") for c in (major, minor, patch)])


def is_tag(tag: str | Column) -> Column:
    return F.coalesce(col(tag).rlike(TAG) & ~col(tag).contains("\n"), F.lit(False))


def tag_date(tag: str | Column) -> Column:
    """The date text of a tag."""
    return F.substring(col(tag), 2, 1 << 30)


def current_tag() -> Column:
    return F.date_format(F.current_date(), "'v'yyyy-MM-dd")
