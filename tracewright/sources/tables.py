"""Typed tables over event-log lines: tasks, stages, jobs, executors, block
updates, SQL scans and applications.

Input lines have ``log_id`` and ``value``; ``seq`` orders a log's lines, for the
tables that depend on order. Each reader keeps its own event class with a substring test before
it parses, and parses only the fields it returns. Over
:func:`tracewright.sources.lines.stage_events` output the filter on ``kind``
reaches the scan instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import partial, reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewright.functions.jsonlines import event_kind
from tracewright.functions.once import computed_once
from tracewright.operators.branches import run_branches
from tracewright.session import map_in_arrow

TASK_END = "SparkListenerTaskEnd"
STAGE_SUBMITTED = "SparkListenerStageSubmitted"
STAGE_COMPLETED = "SparkListenerStageCompleted"
JOB_START = "SparkListenerJobStart"
JOB_END = "SparkListenerJobEnd"
EXECUTOR_ADDED = "SparkListenerExecutorAdded"
EXECUTOR_REMOVED = "SparkListenerExecutorRemoved"
BLOCK_UPDATED = "SparkListenerBlockUpdated"
SQL_START = "SparkListenerSQLExecutionStart"
SQL_UPDATE = "SparkListenerSQLAdaptiveExecutionUpdate"
APP_START = "SparkListenerApplicationStart"
APP_END = "SparkListenerApplicationEnd"
ENVIRONMENT = "SparkListenerEnvironmentUpdate"

_TASK = """
`Stage ID` LONG, `Stage Attempt ID` LONG,
`Task End Reason` STRUCT<Reason: STRING>,
`Task Info` STRUCT<Index: LONG, Attempt: LONG, `Launch Time`: LONG, `Finish Time`: LONG,
  `Executor ID`: STRING, Host: STRING, Speculative: BOOLEAN, Failed: BOOLEAN, Killed: BOOLEAN>,
`Task Metrics` STRUCT<`Memory Bytes Spilled`: LONG, `Disk Bytes Spilled`: LONG,
  `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: LONG, `Local Bytes Read`: LONG>,
  `Shuffle Write Metrics`: STRUCT<`Shuffle Bytes Written`: LONG>>
"""
_STAGE = """
`Stage Info` STRUCT<`Stage ID`: LONG, `Stage Attempt ID`: LONG, `Stage Name`: STRING,
  `Number of Tasks`: LONG, `Submission Time`: LONG, `Completion Time`: LONG, `Failure Reason`: STRING>
"""
_RDDS = """
`Stage Info` STRUCT<`RDD Info`: ARRAY<STRUCT<`RDD ID`: LONG, Name: STRING,
  `Number of Partitions`: LONG, `Storage Level`: STRUCT<`Use Disk`: BOOLEAN, `Use Memory`: BOOLEAN>>>>
"""
_JOB = """
`Job ID` LONG, `Submission Time` LONG, `Completion Time` LONG,
`Job Result` STRUCT<Result: STRING>
"""
_EXECUTOR = """
Timestamp LONG, `Executor ID` STRING,
`Executor Info` STRUCT<Host: STRING, `Total Cores`: LONG>
"""
_BLOCK = """
`Block Updated Info` STRUCT<`Block ID`: STRING,
  `Storage Level`: STRUCT<`Use Disk`: BOOLEAN, `Use Memory`: BOOLEAN>,
  `Memory Size`: LONG, `Disk Size`: LONG>
"""
_CONF = "`Spark Properties` MAP<STRING, STRING>"

_REMOVED = "Timestamp LONG, `Executor ID` STRING"

#: Below these nodes a plan describes how a cached table came to be.
CACHED_NODES = ("InMemoryTableScan",)
_ROOTS = r"\[(.*)\]\s*$"


def _events(lines: DataFrame, schema: str, *kinds: str) -> DataFrame:
    """Lines of some event classes with their parsed fields in ``e``. Lines that do
    not mention a class are not parsed, the others once."""
    if "kind" in lines.columns:
        return computed_once(lines.where(F.col("kind").isin(*kinds)), e=F.from_json("value", schema))
    mentions = reduce(or_, [F.col("value").contains(kind) for kind in kinds])
    # A list of objects is no event, but would parse as its first one.
    is_list = F.startswith(F.ltrim(F.col("value"), F.lit(" \t\r\n")), F.lit("["))
    parsed = computed_once(lines.where(mentions & ~is_list), e=F.from_json("value", f"Event STRING, {schema}"))
    return parsed.where(event_kind(F.col("e.Event")).isin(*kinds))


def _flag(field: str) -> Column:
    return F.coalesce(F.col(field), F.lit(False))


def _bytes(field: str) -> Column:
    return F.coalesce(F.col(field), F.lit(0).cast("long"))


def tasks(lines: DataFrame) -> DataFrame:
    """One row per finished task attempt. Failed attempts may lack metrics,
    which then count as 0 bytes; time comes from the attempt's own clock."""
    info, metrics = "e.`Task Info`", "e.`Task Metrics`"
    launch, finish = F.col(f"{info}.`Launch Time`"), F.col(f"{info}.`Finish Time`")
    read = f"{metrics}.`Shuffle Read Metrics`"
    reason = F.col("e.`Task End Reason`.Reason")
    failed = _flag(f"{info}.Failed") & (F.coalesce(reason, F.lit("")) != "TaskKilled")
    return _events(lines, _TASK, TASK_END).select(
        "log_id",
        F.col("e.`Stage ID`").alias("stage_id"),
        F.coalesce(F.col("e.`Stage Attempt ID`"), F.lit(0).cast("long")).alias("stage_attempt"),
        F.col(f"{info}.Index").alias("task_index"),
        F.col(f"{info}.Attempt").alias("attempt"),
        launch.alias("launch_ms"),
        finish.alias("finish_ms"),
        F.greatest(finish - launch, F.lit(0).cast("long")).alias("duration_ms"),
        F.col(f"{info}.`Executor ID`").alias("executor_id"),
        F.col(f"{info}.Host").alias("host"),
        _flag(f"{info}.Speculative").alias("speculative"),
        failed.alias("failed"),
        (_flag(f"{info}.Killed") | (F.coalesce(reason, F.lit("")) == "TaskKilled")).alias("killed"),
        (_bytes(f"{read}.`Remote Bytes Read`") + _bytes(f"{read}.`Local Bytes Read`")).alias(
            "shuffle_read_bytes"
        ),
        _bytes(f"{metrics}.`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias(
            "shuffle_write_bytes"
        ),
        _bytes(f"{metrics}.`Disk Bytes Spilled`").alias("disk_spill_bytes"),
    )


def stages(lines: DataFrame) -> DataFrame:
    """One row per stage attempt, from its submission and completion events."""
    info = "e.`Stage Info`"
    rows = _events(lines, _STAGE, STAGE_SUBMITTED, STAGE_COMPLETED).select(
        "log_id",
        F.col(f"{info}.`Stage ID`").alias("stage_id"),
        F.col(f"{info}.`Stage Attempt ID`").alias("stage_attempt"),
        F.col(f"{info}.`Stage Name`").alias("name"),
        F.col(f"{info}.`Number of Tasks`").alias("n_tasks"),
        F.col(f"{info}.`Submission Time`").alias("submitted_ms"),
        F.col(f"{info}.`Completion Time`").alias("completed_ms"),
        F.col(f"{info}.`Failure Reason`").alias("failure_reason"),
    )
    keys = ("log_id", "stage_id", "stage_attempt")
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rows.columns if c not in keys])


def cached_rdds(lines: DataFrame) -> DataFrame:
    """RDDs marked for caching with their partition count."""
    rdd = F.explode("e.`Stage Info`.`RDD Info`")
    rdds = _events(lines, _RDDS, STAGE_SUBMITTED, STAGE_COMPLETED).select("log_id", rdd.alias("r"))
    level = "r.`Storage Level`"
    kept = rdds.where(F.col(f"{level}.`Use Disk`") | F.col(f"{level}.`Use Memory`"))
    return kept.groupBy("log_id", F.col("r.`RDD ID`").alias("rdd_id")).agg(
        F.max("r.`Number of Partitions`").alias("n_partitions")
    )


def jobs(lines: DataFrame) -> DataFrame:
    """One row per job; ``result`` is null for a job that never ended."""
    rows = _events(lines, _JOB, JOB_START, JOB_END)
    return rows.groupBy("log_id", F.col("e.`Job ID`").alias("job_id")).agg(
        F.max("e.`Submission Time`").alias("submitted_ms"),
        F.max("e.`Completion Time`").alias("completed_ms"),
        F.max("e.`Job Result`.Result").alias("result"),
    )


def job_labels(lines: DataFrame) -> DataFrame:
    """Each job's description and tags, null where none was set when it started."""
    wanted = "`Job ID` LONG, Properties MAP<STRING, STRING>"
    return _events(lines, wanted, JOB_START).select(
        "log_id",
        F.col("e.`Job ID`").alias("job_id"),
        F.col("e.Properties")["spark.job.description"].alias("description"),
        F.col("e.Properties")["spark.job.tags"].alias("tags"),
    )


def executors(lines: DataFrame) -> DataFrame:
    return _events(lines, _EXECUTOR, EXECUTOR_ADDED).select(
        "log_id",
        F.col("e.`Executor ID`").alias("executor_id"),
        F.col("e.`Executor Info`.Host").alias("host"),
        F.col("e.`Executor Info`.`Total Cores`").alias("cores"),
        F.col("e.Timestamp").alias("added_ms"),
    )


def block_updates(lines: DataFrame, order: str = "seq") -> DataFrame:
    """Updates of cached RDD partitions. The events carry no time, so ``order``
    must name a column that orders a log's lines."""
    info = "e.`Block Updated Info`"
    block = F.col(f"{info}.`Block ID`")
    pattern = r"^rdd_([0-9]+)_([0-9]+)$"
    return (
        _events(lines, _BLOCK, BLOCK_UPDATED)
        .where(block.rlike(pattern))
        .select(
            "log_id",
            F.regexp_extract(block, pattern, 1).try_cast("long").alias("rdd_id"),
            F.regexp_extract(block, pattern, 2).try_cast("long").alias("partition"),
            F.col(order).alias("seq"),
            _flag(f"{info}.`Storage Level`.`Use Memory`").alias("in_memory"),
            _flag(f"{info}.`Storage Level`.`Use Disk`").alias("on_disk"),
        )
    )


def removals(lines: DataFrame) -> DataFrame:
    """Executors that left, with the time."""
    return _events(lines, _REMOVED, EXECUTOR_REMOVED).select(
        "log_id",
        F.col("e.`Executor ID`").alias("executor_id"),
        F.col("e.Timestamp").alias("removed_ms"),
    )


def _walk(plan: str | None) -> Iterator[tuple[int, int | None, int, str | None, str | None, bool]]:
    """Each node of a plan, parents first: its number, its parent's, its depth, name
    and location, and whether it lies below a cached table."""
    try:
        root = json.loads(plan) if plan is not None else None
    except (ValueError, RecursionError):
        return
    waiting, number = [(root, None, 0, False)], 0
    while waiting:
        node, parent, depth, cached = waiting.pop()
        if not isinstance(node, dict):
            continue
        name, metadata = node.get("nodeName"), node.get("metadata")
        location = metadata.get("Location") if isinstance(metadata, dict) else None
        text = [v if isinstance(v, str) else None for v in (name, location)]
        yield number, parent, depth, *text, cached
        children = node.get("children")
        if isinstance(children, list):
            below = cached or (text[0] or "").startswith(CACHED_NODES)
            waiting += [(child, number, depth + 1, below) for child in reversed(children)]
        number += 1


def _plans(lines: DataFrame, order: str) -> DataFrame:
    # The plan stays text in the parsed row: its depth has no schema.
    return _events(lines, "executionId LONG, sparkPlanInfo STRING", SQL_START, SQL_UPDATE).select(
        "log_id",
        F.col("e.executionId").alias("execution_id"),
        F.col(order).alias("seq"),
        F.col("e.sparkPlanInfo").alias("plan"),
    )


def plan_nodes(lines: DataFrame, order: str = "seq") -> DataFrame:
    """``log_id, execution_id, seq, node, parent, depth, name, location, cached``: the
    trees of all SQL plans, one per execution and adaptive update. A plan that cannot
    be read is one row without a node."""
    found = _plans(lines, order)
    columns = ("node", "parent", "depth", "name", "location", "cached")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, nodes = [], []
            for row, plan in enumerate(batch.column("plan").to_pylist()):
                own = list(_walk(plan)) or [(None,) * len(columns)]
                rows += [row] * len(own)
                nodes += own
            carried = batch.select(["log_id", "execution_id", "seq"]).take(pa.array(rows, pa.int64()))
            made = [pa.array([n[i] for n in nodes], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*carried.columns, *made], [*carried.schema.names, *columns])

    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields[:3])
    schema = f"{carried}, node long, parent long, depth long, name string, location string, cached boolean"
    return map_in_arrow(found, task, schema)


def plan_scans(lines: DataFrame, order: str = "seq") -> DataFrame:
    """``log_id, execution_id, seq, locations array<string>``: of every SQL plan, the
    locations of its scans (see :func:`plan_nodes`), none for one that cannot be read."""
    found = _plans(lines, order)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scans = [
                [at for *_, name, at, _ in _walk(plan) if at is not None and (name or "").startswith("Scan ")]
                for plan in batch.column("plan").to_pylist()
            ]
            carried = batch.select(["log_id", "execution_id", "seq"])
            yield carried.append_column("locations", pa.array(scans, pa.list_(pa.string())))

    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields[:3])
    return map_in_arrow(found, task, f"{carried}, locations array<string>")


def file_scans(lines: DataFrame, order: str = "seq") -> DataFrame:
    """One row per SQL execution and root path that its last plan scans, also where the
    scan fills a cached table. Adaptive updates replace an execution's plan."""
    plans = plan_scans(lines, order).where("log_id IS NOT NULL AND execution_id IS NOT NULL")
    # The plans are walked once: an execution's last one is known where they meet.
    last = F.max("seq").over(Window.partitionBy("log_id", "execution_id"))
    found = (
        plans.withColumn("_last", last)
        .where("seq = _last AND size(locations) > 0")
        .select("log_id", "execution_id", F.explode("locations").alias("location"))
    )
    paths = F.split(F.regexp_extract("location", _ROOTS, 1), ", ")
    return (
        found.select("log_id", "execution_id", F.explode(paths).alias("location"))
        .where("location <> '' AND NOT location LIKE '...%'")
        .distinct()
    )


def applications(lines: DataFrame) -> DataFrame:
    """One row per log: start and end of its application, ``n_ends`` end events.
    Logs without any application event are kept."""
    stamp = F.get_json_object("value", "$.Timestamp").try_cast("long")
    if "kind" in lines.columns:
        # All logs from their id column alone; texts of application events only.
        nothing = F.lit(None)
        witnesses = lines.select(
            "log_id", nothing.cast("string").alias("kind"), nothing.cast("long").alias("stamp")
        )
        ours = lines.where(F.col("kind").isin(APP_START, APP_END))
        stamped = ours.select("log_id", "kind", stamp.alias("stamp")).union(witnesses)
    else:
        of_app = F.col("value").contains("SparkListenerApplication")
        kind = F.when(of_app, event_kind(F.get_json_object("value", "$.Event")))
        stamped = lines.select("log_id", kind.alias("kind"), F.when(of_app, stamp).alias("stamp"))
    return stamped.groupBy("log_id").agg(
        F.min(F.when(F.col("kind") == APP_START, F.col("stamp"))).alias("started_ms"),
        F.max(F.when(F.col("kind") == APP_END, F.col("stamp"))).alias("ended_ms"),
        F.count_if(F.col("kind") == APP_END).alias("n_ends"),
    )


def confs(lines: DataFrame) -> DataFrame:
    """The Spark properties of each log as a map ``conf``."""
    return _events(lines, _CONF, ENVIRONMENT).select(
        F.col("log_id").alias("id"), F.col("e.`Spark Properties`").alias("conf")
    )


@dataclass(frozen=True)
class LogTables:
    """The typed tables of a set of logs."""

    tasks: DataFrame
    stages: DataFrame
    jobs: DataFrame
    executors: DataFrame
    applications: DataFrame
    scans: DataFrame
    updates: DataFrame
    rdds: DataFrame | None = None
    removals: DataFrame | None = None


def log_tables(lines: DataFrame) -> LogTables:
    """All tables of some log lines; ``seq`` must order each log's lines."""
    return LogTables(
        tasks=tasks(lines),
        stages=stages(lines),
        jobs=jobs(lines),
        executors=executors(lines),
        applications=applications(lines),
        scans=file_scans(lines),
        updates=block_updates(lines),
        rdds=cached_rdds(lines),
        removals=removals(lines),
    )


def stored(found: LogTables, path: str) -> LogTables:
    """Write each table to Parquet and return scans of them, so the detectors'
    many passes read typed columns and parse nothing again. The tables are written at
    once: a class whose lines are in few files has few tasks, which leave cores free."""

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    tables = {f.name: df for f in fields(LogTables) if (df := getattr(found, f.name)) is not None}
    writes = {name: partial(store, name, df) for name, df in tables.items()}
    try:
        return LogTables(**run_branches(found.tasks.sparkSession, writes, len(writes)))
    except ExceptionGroup as failed:
        raise failed.exceptions[0]
