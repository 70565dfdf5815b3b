"""How a log is stored: single file or rolling directory, codec, size, digest.

The input is a file listing with ``log_id, path, name, is_file, length``;
``is_dir_log`` tells a directory's children from single files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tracewright.functions.text import (
    CODECS,
    MARKER_PREFIX,
    ROLLED_NAME,
    codec_of,
    path_parts,
)
from tracewright.operators.skew import salted_join
from tracewright.session import map_in_arrow


# All codecs a file can have, in the order mixed ones are reported.
STORED_CODECS = tuple(sorted((*CODECS, "none")))


def event_files(files: DataFrame) -> DataFrame:
    """Rolled event files with their index ``idx`` and ``codec``."""
    index = F.regexp_extract("name", ROLLED_NAME, 1)
    return (
        files.where(F.col("is_file") & F.col("name").rlike(ROLLED_NAME))
        .withColumn("idx", index.try_cast("long"))
        .withColumn("codec", codec_of("name"))
    )


def rolling_dir_check(files: DataFrame) -> DataFrame:
    """Per directory: file count, index range, whether the indexes are exactly
    ``1..k``, whether a marker exists, the codecs, and the first ``error``. An index
    beyond 64 bits is none."""
    is_event = F.col("is_file") & F.col("name").rlike(ROLLED_NAME)
    idx = F.when(is_event, F.regexp_extract("name", ROLLED_NAME, 1).try_cast("long"))
    codec = F.when(is_event, codec_of("name"))
    # Copies of one index collapse first, so no directory needs a distinct pass.
    by_index = (
        files.withColumns({"idx": idx, "codec": codec})
        .groupBy("log_id", "idx")
        .agg(
            F.count_if(is_event).alias("n"),
            F.bool_or(F.startswith(F.col("name"), F.lit(MARKER_PREFIX))).alias("marker"),
            *[F.bool_or(F.col("codec") == c).alias(f"_{c}") for c in STORED_CODECS],
        )
    )
    checked = by_index.groupBy("log_id").agg(
        F.sum("n").alias("n_files"),
        F.min("idx").alias("min_idx"),
        F.max("idx").alias("max_idx"),
        F.count("idx").alias("_indexes"),
        F.bool_or("marker").alias("has_marker"),
        *[F.bool_or(f"_{c}").alias(f"_{c}") for c in STORED_CODECS],
    )
    present = F.array(*[F.when(F.col(f"_{c}"), F.lit(c)) for c in STORED_CODECS])
    checked = checked.withColumn("codecs", F.array_compact(present)).withColumn(
        "contiguous",
        (F.col("n_files") > 0)
        & (F.col("min_idx") == 1)
        & (F.col("max_idx") == F.col("n_files"))
        & (F.col("_indexes") == F.col("n_files")),
    )
    error = (
        F.when(F.col("n_files") == 0, "no event files")
        .when(~F.col("contiguous"), F.concat(F.lit("event file indexes are not 1.."), "n_files"))
        .when(~F.col("has_marker"), "no marker file")
    )
    return checked.select(
        "log_id",
        "n_files",
        "min_idx",
        "max_idx",
        F.coalesce("contiguous", F.lit(False)).alias("contiguous"),
        "has_marker",
        "codecs",
        error.alias("error"),
    )


def rolling_file_order(files: DataFrame) -> DataFrame:
    """Event files of sound rolling logs in numeric index order."""
    sound = rolling_dir_check(files).where(F.col("error").isNull()).select("log_id")
    ordered = salted_join(event_files(files), sound, ["log_id"], ["name"], "left_semi")
    return ordered.select("log_id", "idx", "name").orderBy("log_id", "idx")


def log_layout(files: DataFrame, is_dir_log: str = "is_dir_log") -> DataFrame:
    """Per log: ``layout, compression, error``. A rolling log must be sound and
    use one codec."""
    mixed = F.concat(F.lit("event files mix codecs "), F.array_join("codecs", ", "))
    rolling = rolling_dir_check(files.where(is_dir_log)).select(
        "log_id",
        F.lit("rolling-dir").alias("layout"),
        F.when(F.size("codecs") == 1, F.col("codecs")[0]).alias("compression"),
        F.coalesce("error", F.when(F.size("codecs") > 1, mixed)).alias("error"),
    )
    single = files.where(~F.col(is_dir_log)).select(
        "log_id",
        F.lit("single-file").alias("layout"),
        codec_of("name").alias("compression"),
        F.lit(None).cast("string").alias("error"),
    )
    return rolling.unionByName(single)


def log_size(files: DataFrame) -> DataFrame:
    """Bytes per log over all its files."""
    return files.where("is_file").groupBy("log_id").agg(F.sum("length").alias("size_bytes"))


def sha256_tag(content: str | Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def _directory_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash manifest lines that arrive sorted by directory and path; one
    running hash is the whole state."""
    current, running = None, None

    def out(log_id, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"log_id": [log_id], "checksum": [f"sha256:{digest.hexdigest()}"]}
        )

    for batch in batches:
        for log_id, line in zip(batch.column("log_id").to_pylist(), batch.column("line").to_pylist()):
            if log_id != current or running is None:
                if running is not None:
                    yield out(current, running)
                current, running = log_id, hashlib.sha256()
            running.update(line)
    if running is not None:
        yield out(current, running)


def dir_checksum(files: DataFrame) -> DataFrame:
    """Checksum per directory: SHA-256 over ``<path> NUL <digest> NL`` of its
    files in order of path components.

    ``files`` has ``log_id, path`` (relative to the log) and ``digest``. A hash
    over one directory is sequential by definition; its manifest is sorted by
    the shuffle and streamed, never held. File contents are hashed before, in
    parallel.
    """
    line = F.concat(
        F.col("path").cast("binary"),
        F.lit(bytearray(b"\0")),
        F.col("digest").cast("binary"),
        F.lit(bytearray(b"\n")),
    )
    manifest = files.select(
        F.col("log_id").cast("string").alias("log_id"),
        path_parts("path").alias("_parts"),
        line.alias("line"),
    )
    ordered = manifest.repartition("log_id").sortWithinPartitions("log_id", "_parts")
    schema = "log_id string, checksum string"
    return map_in_arrow(ordered.select("log_id", "line"), _directory_digests, schema)


def log_relpath(run_id: str | Column, is_dir_log: str | Column, name: str | Column) -> Column:
    """Where a log is stored in the corpus."""
    run_id = F.col(run_id) if isinstance(run_id, str) else run_id
    is_dir_log = F.col(is_dir_log) if isinstance(is_dir_log, str) else is_dir_log
    name = F.col(name) if isinstance(name, str) else name
    codec = codec_of(name)
    suffix = F.when(codec == "none", ".ndjson").otherwise(F.concat(F.lit("."), codec))
    return F.when(is_dir_log, F.concat(F.lit("logs/"), run_id, F.lit("/"), name)).otherwise(
        F.concat(F.lit("logs/"), run_id, suffix)
    )
