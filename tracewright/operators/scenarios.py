"""Run one definition of the run matrix on this session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewright.operators import dml, workload
from tracewright.session import staged

# Settings that are Spark confs a session can change; the rest of a run's
# confs are fixed when its application is submitted.
SESSION_CONFS = {
    "aqe": "spark.sql.adaptive.enabled",
    "shuffle_partitions": "spark.sql.shuffle.partitions",
}
_MERGED = "status = 'merged'"


def run_scenario(spark: SparkSession, settings: Mapping[str, str], output: str) -> DataFrame:
    """Run a definition's workload into ``output``.

    ``settings`` is the full map of :func:`tracewright.operators.runs.run_settings`.
    Returns the result of the join workload's second action, or the count
    checks of a DML run; a check that fails raises. Everything runs here, under
    the run's confs.
    """
    if settings["failure"] != "none":
        raise ValueError("runs that fail on purpose are not workloads")
    before = {conf: spark.conf.get(conf) for conf in SESSION_CONFS.values()}
    for name, conf in SESSION_CONFS.items():
        spark.conf.set(conf, settings[name])
    try:
        if settings["dml"] != "none":
            found = _run_dml(spark, settings["dml"], int(settings["row_count"]), output)
        else:
            found = _run_join(spark, settings, output)
            if settings["second_action"] == "none":
                return found
        return staged(found, "scenario")
    finally:
        for conf, value in before.items():
            spark.conf.set(conf, value)


def _run_join(spark: SparkSession, settings: Mapping[str, str], output: str) -> DataFrame:
    cardinality = int(settings["join_cardinality"])
    fact = workload.fact_table(
        workload.id_range(spark, int(settings["row_count"])),
        cardinality,
        settings["skew"],
        int(settings["payload_columns"]),
        draws="random",
        seed=0,
    )
    keys = workload.key_range(spark, cardinality)
    dimensions = [
        workload.Dimension(workload.dimension_table(keys, str(i)), "join_key")
        for i in range(workload.DEFAULT_JOIN_TABLES)
    ]
    return workload.run_workload(
        fact,
        dimensions,
        output,
        persist_mode=settings["caching"],
        second_action=settings["second_action"],
        staging_path=f"{output}-fact-source" if settings["fact_source"] == "parquet" else None,
        force_merge=True,
    )


def _run_dml(spark: SparkSession, mode: str, n: int, path: str) -> DataFrame:
    """Seed a table, run one statement on it, and check what it left."""
    dml.seed_table(spark.range(n), path)
    source = dml.merge_source_rows(spark.range(n + n // dml.INSERT_FRACTION), n)
    schema = source.schema

    def table() -> DataFrame:
        return spark.read.schema(schema).parquet(path)

    if mode in ("merge-sql", "merge-api"):
        dml.replace_partitions(dml.merge(table(), source, "id"), path, "bucket")
        counted = {"merge total": "true", "merge merged": _MERGED}
    elif mode == "update":
        assignments = {"value": f"value * {dml.UPDATE_FACTOR}", "status": "'updated'"}
        updated = dml.update_where(table(), f"id % {dml.UPDATE_EVERY} = 0", assignments)
        dml.replace_partitions(updated, path, "bucket")
        counted = {"update total": "true", "update updated": "status = 'updated'"}
    elif mode == "delete":
        kept = dml.delete_where(table(), f"id % {dml.DELETE_EVERY} = 0")
        dml.replace_table(kept, path, "bucket")
        counted = {"delete total": "true"}
    elif mode == "concurrent-merge":
        dml.merge_partitions(spark, path, source, "id", "bucket", dml.CONCURRENT_BUCKETS)
        buckets = ", ".join(map(str, dml.CONCURRENT_BUCKETS))
        counted = {"concurrent merged": f"{_MERGED} AND bucket IN ({buckets})"}
    else:
        raise ValueError(f"unknown DML mode {mode!r}")
    spark.catalog.refreshByPath(path)
    wanted = dml.expected_counts(spark.range(n)).where(F.col("check_name").isin(*counted))
    return dml.check_counts([dml.named_counts(table(), counted)], wanted, strict=True)
