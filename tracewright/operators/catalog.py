"""The corpus catalog: one row per log, appended to and resumed by id."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, VariantType

from tracewright.functions.text import current_tag, path_parts, stem, tag_date
from tracewright.operators.runs import run_config, typed_config
from tracewright.operators.skew import salted_join
from tracewright.session import hadoop_path
from tracewright.sources.layout import log_relpath

# Field names and types of a catalog entry, in JSON key order.
CATALOG_SCHEMA = """
checksum STRING, compression STRING, config_diff VARIANT, data_repo_tag STRING,
fetched_at STRING, fires_detectors ARRAY<STRING>, fires_detectors_checked_with STRING,
generated_at STRING, id STRING, known_misses MAP<STRING, STRING>, license STRING,
log_layout STRING, path STRING, scenario STRING, size_bytes BIGINT, source STRING,
source_url STRING, spark_version STRING, table_format STRING, targets_detectors ARRAY<STRING>
"""
SELF_GENERATED, EXTERNAL = "self-generated", "external"

ACCEPTED, KNOWN, INVALID, DUPLICATE = "accepted", "known", "invalid", "duplicate"


_PREVIOUS = ".previous"


def load_catalog(spark: SparkSession, path: str, json_array: bool = False) -> DataFrame:
    """A catalog stored as JSON lines, or as one JSON array; a path that does not
    exist is an empty catalog, unless a save was cut short: then the catalog it was
    replacing is read. A folder without a finished catalog raises. Fields that
    ``CATALOG_SCHEMA`` does not name are kept, with the types found."""
    filesystem, place = hadoop_path(spark, path)
    if not filesystem.exists(place):
        path += _PREVIOUS
        filesystem, place = hadoop_path(spark, path)
        if not filesystem.exists(place):
            return spark.createDataFrame([], CATALOG_SCHEMA)
    if filesystem.getFileStatus(place).isDirectory() and not len(filesystem.listStatus(place)):
        raise FileNotFoundError(f"{path} holds no catalog; it was emptied or never finished")
    options = {"multiLine": str(json_array).lower()}
    known = StructType.fromDDL(CATALOG_SCHEMA)
    found = spark.read.options(**options).json(path).schema
    further = [field for field in found.fields if field.name not in known.names]
    return spark.read.options(**options).schema(StructType(known.fields + further)).json(path)


def save_catalog(entries: DataFrame, path: str) -> None:
    """Replace the catalog at ``path`` with JSON lines; null fields are left out.

    ``entries`` may read ``path``: the new catalog is written beside it and swapped
    in. Until then, and if the swap is cut short, the old one can be loaded.
    """
    spark = entries.sparkSession
    fresh = f"{path}.{uuid4().hex}"
    entries.select(*sorted(entries.columns)).write.json(fresh)
    filesystem, place = hadoop_path(spark, path)
    before = hadoop_path(spark, path + _PREVIOUS)[1]
    if filesystem.exists(place):
        filesystem.delete(before, True)
        _renamed(filesystem, place, before)
    _renamed(filesystem, hadoop_path(spark, fresh)[1], place)
    filesystem.delete(before, True)


def _renamed(filesystem, source, target) -> None:
    if not filesystem.rename(source, target):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def entry_json(entries: DataFrame, ordinal: str) -> DataFrame:
    """Each entry as JSON with sorted keys and without null fields."""
    fields = sorted(c for c in entries.columns if c != ordinal)
    return entries.select(ordinal, F.to_json(F.struct(*fields)).alias("entry_json"))


def _config(run_rows: DataFrame) -> Column:
    if run_rows.schema["config"].dataType == VariantType():
        return F.col("config")
    if "event_log_confs" in run_rows.columns:
        return run_config()
    nested = {c: F.col(c) for c in ("spark_confs",) if c in run_rows.columns}
    return typed_config("config", **nested)


def catalog_entries(
    runs: DataFrame, files: DataFrame, layouts: DataFrame, tag: Column
) -> DataFrame:
    """Entries for runs whose log was accepted.

    ``runs`` has ``id, spark_version, table_format, scenario, config,
    targets_detectors, known_misses``; the config is kept whole, as one nested object
    with its types, be it a VARIANT or a map as :func:`runs.all_runs` has it (then with
    ``spark_confs`` and ``event_log_confs`` where present); ``files`` one row per log with ``id,
    name, is_dir_log, checksum, size_bytes``; ``layouts`` the result of
    ``log_layout``. Layout and codec are recorded only where the log is not
    one plain file, and empty known misses are left out.
    """
    layouts = layouts.where(F.col("error").isNull()).withColumnRenamed("log_id", "id").drop("error")
    plain = (F.col("layout") == "single-file") & (F.col("compression") == "none")
    # All three inputs have one row per id.
    joined = runs.join(files, "id").join(layouts, "id")
    return joined.select(
        "id",
        tag.alias("data_repo_tag"),
        log_relpath("id", "is_dir_log", "name").alias("path"),
        "checksum",
        F.lit(SELF_GENERATED).alias("source"),
        "spark_version",
        "table_format",
        "scenario",
        _config(runs).alias("config_diff"),
        "targets_detectors",
        F.when(F.size("known_misses") > 0, F.col("known_misses")).alias("known_misses"),
        tag_date(tag).alias("generated_at"),
        "size_bytes",
        F.when(~plain, F.col("layout")).alias("log_layout"),
        F.when(~plain, F.col("compression")).alias("compression"),
    )


def pending(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows whose id the catalog lacks."""
    return rows.join(catalog.select("id"), "id", "left_anti")


def duplicates(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows whose id the catalog already has."""
    return rows.join(catalog.select("id"), "id", "left_semi")


def append_entries(catalog: DataFrame, new: DataFrame, strict: bool = False) -> DataFrame:
    """The catalog with the new entries it lacks; see :func:`duplicates` for
    the others. With ``strict`` a duplicate raises instead."""
    if not strict:
        return catalog.unionByName(pending(new, catalog), allowMissingColumns=True)
    known = catalog.select("id", F.lit(True).alias("_known"))
    message = F.concat(F.lit("already in the catalog: "), F.col("id"))
    checked = (
        new.join(known, "id", "left")
        .withColumn("id", F.when(F.col("_known"), F.raise_error(message)).otherwise(F.col("id")))
        .drop("_known")
    )
    return catalog.unionByName(checked, allowMissingColumns=True)


def enrich(catalog: DataFrame, fired: DataFrame, checked_with: str) -> DataFrame:
    """Record observed tags (``id, fired``) on the entries they belong to;
    other entries keep what they had."""
    observed = fired.where(F.col("fired").isNotNull()).select("id", "fired")
    checked = F.when(F.col("fired").isNotNull(), F.lit(checked_with))
    new = {
        "fires_detectors": F.coalesce("fired", "fires_detectors"),
        "fires_detectors_checked_with": F.coalesce(checked, "fires_detectors_checked_with"),
    }
    return catalog.join(observed, "id", "left").withColumns(new).drop("fired")


def generation_tag(catalog: DataFrame, ordinal: str) -> DataFrame:
    """The tag of the catalog's first entry, else today's."""
    first = F.min_by("data_repo_tag", ordinal)
    return catalog.agg(F.coalesce(first, current_tag()).alias("tag"))


def external_url(repo: Column, branch: Column, subpath: Column, name: Column) -> Column:
    base = F.regexp_replace(repo, r"\.git$", "")
    return F.concat(base, F.lit("/tree/"), branch, F.lit("/"), subpath, F.lit("/"), name)


def external_ingest(files: DataFrame, validity: DataFrame, catalog: DataFrame) -> DataFrame:
    """Decide on every third-party file, in one pass over all of them.

    ``files`` has ``path, name, repo, branch, subpath``; ``validity`` has
    ``path, reason`` for invalid files. Status is ``known`` (id already in the
    catalog), ``invalid`` with the reason, ``duplicate`` (another valid file
    with this id has a smaller path) or ``accepted``. Adds ``id, dest,
    source_url`` and keeps other columns of ``files``.
    """
    kept = [c for c in files.columns if c not in ("path", "name", "repo", "branch", "subpath")]
    id_ = F.concat(F.lit("external-"), stem("name"))
    named = files.withColumn("id", id_).join(
        validity.where(F.col("reason").isNotNull()).select("path", "reason"), "path", "left"
    )
    # Many files may share a stem: find each id's winner map-side, then match
    # the files to it with the crowded ids split.
    order = F.struct(path_parts("path").alias("parts"), F.col("path").alias("path"))
    winner = F.min(F.when(F.col("reason").isNull(), order))["path"]
    ids = (
        named.groupBy("id")
        .agg(winner.alias("_winner"))
        .join(catalog.select("id", F.lit(True).alias("_known")), "id", "left")
    )
    status = (
        F.when(F.col("_known"), KNOWN)
        .when(F.col("reason").isNotNull(), INVALID)
        .when(F.col("_winner") != F.col("path"), DUPLICATE)
        .otherwise(ACCEPTED)
    )
    decided = salted_join(named, ids, ["id"], ["path"], "left").withColumn("status", status)
    return decided.select(
        "id",
        "path",
        "status",
        F.when(F.col("status") == INVALID, F.col("reason")).alias("reason"),
        F.concat(F.lit("logs/external/"), "id", F.lit(".ndjson")).alias("dest"),
        external_url(F.col("repo"), F.col("branch"), F.col("subpath"), F.col("name")).alias(
            "source_url"
        ),
        *kept,
    )


def external_entries(
    decided: DataFrame, stored: DataFrame, license_name: Column, tag: Column
) -> DataFrame:
    """Catalog entries of the accepted files; ``stored`` has ``path, checksum,
    size_bytes``."""
    accepted = decided.where(F.col("status") == ACCEPTED).join(stored, "path")
    return accepted.select(
        "id",
        tag.alias("data_repo_tag"),
        F.col("dest").alias("path"),
        "checksum",
        F.lit(EXTERNAL).alias("source"),
        "source_url",
        license_name.alias("license"),
        tag_date(tag).alias("fetched_at"),
        "size_bytes",
    )
