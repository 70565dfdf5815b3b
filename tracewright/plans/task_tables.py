"""The given tables read as event-log tables, and rendered as event lines.

Logs are ``app-<n>``: five suppliers, 75 customers or 7.5 users each. Line
items are task attempts of their supplier's stage. Stages differ on purpose by
supplier number, so that each detector fires on some and not on others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracewright.functions.once import computed_once
from tracewright.plans.registry import spread, table
from tracewright.sources import tables
from tracewright.sources.tables import LogTables

EPOCH_MS = 788918400000

# One expression text per column, shared by Spark and the oracle where the
# dialects agree; {div} and {long} differ.
TASK_COLUMNS = {
    "log_id": "'app-' || CAST(l_suppkey {div} 5 AS {text})",
    "stage_id": "l_suppkey",
    "stage_attempt": "CAST(0 AS BIGINT)",
    "task_index": "l_orderkey",
    "attempt": "CAST(l_linenumber - 1 AS BIGINT)",
    "launch_ms": "{launch}",
    "finish_ms": "{launch} + {duration}",
    "duration_ms": "{duration}",
    "executor_id": "'e' || CAST(l_partkey % 10 AS {text})",
    "host": "'host-' || CAST(l_partkey % 5 AS {text})",
    "speculative": "l_linestatus = 'O'",
    "failed": "l_returnflag = 'A'",
    "killed": "l_returnflag = 'R'",
    "shuffle_read_bytes": "{written} * CASE WHEN l_suppkey % 7 = 0 THEN 1 "
    "WHEN l_suppkey % 8 = 2 AND l_partkey % 10 = 7 THEN 90 ELSE 1 + l_suppkey % 40 END",
    "shuffle_write_bytes": "{written}",
    "disk_spill_bytes": "CASE WHEN l_suppkey % 3 = 0 THEN CAST(round(l_tax * 100) AS BIGINT) * 1048576 "
    "ELSE CAST(0 AS BIGINT) END",
}
DURATION = (
    "CAST(l_quantity * CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 1000 END AS BIGINT) * "
    "CASE WHEN l_suppkey % 6 = 0 AND l_orderkey % 10 = 0 THEN 10 "
    "WHEN l_suppkey % 4 = 1 AND l_partkey % 5 = 3 THEN 4 ELSE 1 END"
)
WRITTEN = (
    "CAST(round(l_extendedprice * CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 100 END) AS BIGINT)"
)


def _task_sql(dialect: dict[str, str]) -> dict[str, str]:
    return {
        name: text.format(duration=DURATION, written=WRITTEN, **dialect)
        for name, text in TASK_COLUMNS.items()
    }




def epoch_ms(column: str) -> str:
    """Milliseconds of a zoneless timestamp read as UTC, in any session zone."""
    return f"unix_millis(from_utc_timestamp(CAST({column} AS TIMESTAMP), current_timezone()))"


SPARK_DIALECT = {
    "div": "div",
    "text": "STRING",
    "launch": epoch_ms("l_shipdate"),
}
DUCK_DIALECT = {"div": "//", "text": "VARCHAR", "launch": "epoch_us(l_shipdate) // 1000"}

TASKS_CTE = "tasks AS (SELECT " + ", ".join(
    f"{text} AS {name}" for name, text in _task_sql(DUCK_DIALECT).items()
) + " FROM lineitem)"
STAGES_CTE = f"""
stages AS (SELECT 'app-' || (s_suppkey // 5)::VARCHAR AS log_id, s_suppkey AS stage_id, 0::BIGINT AS stage_attempt,
  s_name AS name, (10 + s_nationkey)::BIGINT AS n_tasks, {EPOCH_MS} + s_suppkey * 60000 AS submitted_ms,
  {EPOCH_MS} + s_suppkey * 60000 + 216000000000 AS completed_ms,
  CASE WHEN s_acctbal < 500 THEN 'Job aborted' END AS failure_reason FROM supplier)
"""
APPS_CTE = """
applications AS (SELECT log_id, min(submitted_ms) - 1000 AS started_ms,
  CASE WHEN bool_or(n_tasks > 32) THEN NULL ELSE max(completed_ms) + 1000 END AS ended_ms,
  CASE WHEN bool_or(n_tasks > 32) THEN 0 ELSE 1 END::BIGINT AS n_ends FROM stages GROUP BY log_id)
"""
EXECUTORS_CTE = f"""
executors AS (SELECT 'app-' || (c_custkey // 75)::VARCHAR AS log_id, 'e' || c_custkey::VARCHAR AS executor_id,
  'host-' || c_nationkey::VARCHAR AS host, (1 + c_nationkey % 8)::BIGINT AS cores,
  {EPOCH_MS} + (c_custkey // 75) * 300000 + 20000 + ((c_custkey // 75) % 4) * 10000
    + c_nationkey * 100 AS added_ms FROM customer)
"""
REMOVALS_CTE = """
removals AS (SELECT log_id, executor_id, added_ms + cores * 4000000000 AS removed_ms FROM executors
  WHERE substr(executor_id, 2)::BIGINT % 3 = 0)
"""
JOBS_CTE = """
jobs AS (SELECT 'app-' || (o_custkey // 75)::VARCHAR AS log_id, o_orderkey AS job_id,
  epoch_us(o_orderdate) // 1000 AS submitted_ms,
  CASE WHEN o_orderstatus <> 'P' THEN epoch_us(o_orderdate) // 1000 + 3600000 END AS completed_ms,
  CASE o_orderstatus WHEN 'F' THEN 'JobFailed' WHEN 'O' THEN 'JobSucceeded' END AS result FROM orders)
"""
SCANS_CTE = """
scans AS (SELECT 'app-' || (o_custkey // 75)::VARCHAR AS log_id, o_orderkey AS execution_id,
  '/warehouse/c' || o_custkey::VARCHAR AS location FROM orders)
"""
UPDATES_CTE = """
updates AS (SELECT 'app-' || (user_id * 2 // 15)::VARCHAR AS log_id, user_id AS rdd_id,
  event_id % 50 AS partition, event_id AS seq, event_type IN ('click', 'view') AS in_memory,
  event_type = 'error' AS on_disk FROM events)
"""


def _app(number: str) -> Column:
    return F.expr(f"'app-' || CAST({number} AS STRING)")


def line_tasks(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    return lineitem.selectExpr(
        *[f"{text} AS {name}" for name, text in _task_sql(SPARK_DIALECT).items()]
    )


def supplier_stages(spark: SparkSession, folder: str) -> DataFrame:
    submitted = F.lit(EPOCH_MS) + F.col("s_suppkey") * 60000
    return table(spark, folder, "supplier").select(
        _app("s_suppkey div 5").alias("log_id"),
        F.col("s_suppkey").alias("stage_id"),
        F.lit(0).cast("long").alias("stage_attempt"),
        F.col("s_name").alias("name"),
        (F.col("s_nationkey") + 10).cast("long").alias("n_tasks"),
        submitted.alias("submitted_ms"),
        (submitted + F.lit(216000000000)).alias("completed_ms"),
        F.when(F.col("s_acctbal") < 500, "Job aborted").alias("failure_reason"),
    )


def stage_applications(stages: DataFrame) -> DataFrame:
    unfinished = F.bool_or(F.col("n_tasks") > 32)
    return stages.groupBy("log_id").agg(
        (F.min("submitted_ms") - 1000).alias("started_ms"),
        F.when(~unfinished, F.max("completed_ms") + 1000).alias("ended_ms"),
        F.when(unfinished, 0).otherwise(1).cast("long").alias("n_ends"),
    )


def customer_executors(spark: SparkSession, folder: str) -> DataFrame:
    log = F.expr("c_custkey div 75")
    added = F.lit(EPOCH_MS) + log * 300000 + 20000 + (log % 4) * 10000 + F.col("c_nationkey") * 100
    return table(spark, folder, "customer").select(
        _app("c_custkey div 75").alias("log_id"),
        F.concat(F.lit("e"), "c_custkey").alias("executor_id"),
        F.concat(F.lit("host-"), "c_nationkey").alias("host"),
        (F.col("c_nationkey") % 8 + 1).cast("long").alias("cores"),
        added.alias("added_ms"),
    )


def executor_removals(executors: DataFrame) -> DataFrame:
    """Every third executor leaves before its application ends."""
    leaving = executors.where(F.substring("executor_id", 2, 20).cast("long") % 3 == 0)
    removed = F.col("added_ms") + F.col("cores") * F.lit(4000000000)
    return leaving.select("log_id", "executor_id", removed.alias("removed_ms"))


def order_jobs(spark: SparkSession, folder: str) -> DataFrame:
    submitted = F.expr(epoch_ms("o_orderdate"))
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        _app("o_custkey div 75").alias("log_id"),
        F.col("o_orderkey").alias("job_id"),
        submitted.alias("submitted_ms"),
        F.when(status != "P", submitted + 3600000).alias("completed_ms"),
        F.when(status == "F", "JobFailed").when(status == "O", "JobSucceeded").alias("result"),
    )


def order_scans(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _app("o_custkey div 75").alias("log_id"),
        F.col("o_orderkey").alias("execution_id"),
        F.concat(F.lit("/warehouse/c"), "o_custkey").alias("location"),
    )


def event_updates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        _app("(user_id * 2) div 15").alias("log_id"),
        F.col("user_id").alias("rdd_id"),
        (F.col("event_id") % 50).alias("partition"),
        F.col("event_id").alias("seq"),
        F.col("event_type").isin("click", "view").alias("in_memory"),
        (F.col("event_type") == "error").alias("on_disk"),
    )


def direct_tables(spark: SparkSession, folder: str) -> LogTables:
    stages = supplier_stages(spark, folder)
    executors = customer_executors(spark, folder)
    return LogTables(
        tasks=line_tasks(spark, folder),
        stages=stages,
        jobs=order_jobs(spark, folder),
        executors=executors,
        applications=stage_applications(stages),
        scans=order_scans(spark, folder),
        updates=event_updates(spark, folder),
        removals=executor_removals(executors),
    )


def _line(df: DataFrame, event: str | Column, seq: Column | None = None, **fields: Column) -> DataFrame:
    """Rows as event lines; ``_`` in a field name stands for a space."""
    event = F.lit(event) if isinstance(event, str) else event
    record = F.struct(
        event.alias("Event"), *[c.alias(name.replace("_", " ")) for name, c in fields.items()]
    )
    seq = F.lit(0).cast("long") if seq is None else seq
    rendered = computed_once(df, value=F.to_json(record))
    return rendered.select("log_id", seq.alias("seq"), "value")


def _record(**fields: Column) -> Column:
    return F.struct(*[c.alias(name.replace("_", " ")) for name, c in fields.items()])


def task_lines(tasks: DataFrame) -> DataFrame:
    c, tasks = F.col, spread(tasks)
    reason = (
        F.when(c("killed"), "TaskKilled").when(c("failed"), "ExceptionFailure").otherwise("Success")
    )
    info = _record(
        Index=c("task_index"),
        Attempt=c("attempt"),
        Launch_Time=c("launch_ms"),
        Finish_Time=c("finish_ms"),
        Executor_ID=c("executor_id"),
        Host=c("host"),
        Speculative=c("speculative"),
        Failed=c("failed"),
        Killed=c("killed"),
    )
    read = c("shuffle_read_bytes")
    metrics = _record(
        Disk_Bytes_Spilled=c("disk_spill_bytes"),
        Shuffle_Read_Metrics=_record(Remote_Bytes_Read=read - 1, Local_Bytes_Read=read - read + 1),
        Shuffle_Write_Metrics=_record(Shuffle_Bytes_Written=c("shuffle_write_bytes")),
    )
    return _line(
        tasks,
        tables.TASK_END,
        Stage_ID=c("stage_id"),
        Stage_Attempt_ID=c("stage_attempt"),
        Task_End_Reason=_record(Reason=reason),
        Task_Info=info,
        Task_Metrics=metrics,
    )


def stage_lines(stages: DataFrame) -> DataFrame:
    c = F.col
    start = {
        "Stage_ID": c("stage_id"),
        "Stage_Attempt_ID": c("stage_attempt"),
        "Stage_Name": c("name"),
        "Number_of_Tasks": c("n_tasks"),
        "Submission_Time": c("submitted_ms"),
    }
    end = {**start, "Completion_Time": c("completed_ms"), "Failure_Reason": c("failure_reason")}
    submitted = _line(stages, tables.STAGE_SUBMITTED, Stage_Info=_record(**start))
    return submitted.union(_line(stages, tables.STAGE_COMPLETED, Stage_Info=_record(**end)))


def application_lines(applications: DataFrame) -> DataFrame:
    started = _line(applications, tables.APP_START, App_ID=F.col("log_id"), Timestamp=F.col("started_ms"))
    ended = applications.where(F.col("ended_ms").isNotNull())
    return started.union(_line(ended, tables.APP_END, Timestamp=F.col("ended_ms")))


def executor_lines(executors: DataFrame) -> DataFrame:
    info = _record(Host=F.col("host"), Total_Cores=F.col("cores"))
    return _line(
        executors,
        tables.EXECUTOR_ADDED,
        Timestamp=F.col("added_ms"),
        Executor_ID=F.col("executor_id"),
        Executor_Info=info,
    )


def removal_lines(removals: DataFrame) -> DataFrame:
    return _line(
        removals,
        tables.EXECUTOR_REMOVED,
        Timestamp=F.col("removed_ms"),
        Executor_ID=F.col("executor_id"),
        Removed_Reason=F.lit("idle"),
    )


def job_lines(jobs: DataFrame) -> DataFrame:
    c = F.col
    named = F.create_map(F.lit("spark.job.description"), F.concat(F.lit("order "), c("job_id").cast("string")))
    properties = F.when(c("job_id") % 3 != 0, named)
    started = _line(
        jobs,
        tables.JOB_START,
        Job_ID=c("job_id"),
        Submission_Time=c("submitted_ms"),
        Properties=properties,
    )
    ended = _line(
        jobs.where(c("result").isNotNull()),
        tables.JOB_END,
        Job_ID=c("job_id"),
        Completion_Time=c("completed_ms"),
        Job_Result=_record(Result=c("result")),
    )
    return started.union(ended)


def _plan(location: Column, note: Column) -> Column:
    """A plan with the scan two levels down, and text that only looks like a scan."""
    leaf = F.struct(
        F.lit("Scan parquet").alias("nodeName"),
        note.alias("simpleString"),
        F.array().cast("array<string>").alias("children"),
        F.struct(location.alias("Location"), F.lit("Parquet").alias("Format")).alias("metadata"),
    )
    child = F.struct(F.lit("Filter").alias("nodeName"), note.alias("simpleString"), F.array(leaf).alias("children"))
    return F.struct(F.lit("AdaptiveSparkPlan").alias("nodeName"), F.array(child).alias("children"))


def scan_lines(scans: DataFrame) -> DataFrame:
    """A first plan per execution, and for every other one an adaptive update: it names
    the location that counts, while the first plan of those named another."""
    note = F.lit('contains(note, {"Location":"InMemoryFileIndex(1 paths)[/nowhere]"})')
    kind = "org.apache.spark.sql.execution.ui."
    updated = F.col("execution_id") % 2 == 0

    def at(path: Column) -> Column:
        return F.concat(F.lit("InMemoryFileIndex(1 paths)["), path, F.lit("]"))

    def lines(rows: DataFrame, event: str, path: Column, seq: int) -> DataFrame:
        plan = _plan(at(path), note)
        return _line(
            rows, kind + event, F.lit(seq).cast("long"), executionId=F.col("execution_id"), sparkPlanInfo=plan
        )

    location = F.col("location")
    draft = F.when(updated, F.concat(location, F.lit("-draft"))).otherwise(location)
    first = lines(scans, tables.SQL_START, draft, 0)
    return first.union(lines(scans.where(updated), tables.SQL_UPDATE, location, 1))


def update_lines(updates: DataFrame) -> DataFrame:
    c = F.col
    block = F.concat(F.lit("rdd_"), "rdd_id", F.lit("_"), c("partition").cast("string"))
    level = _record(Use_Disk=c("on_disk"), Use_Memory=c("in_memory"))
    info = _record(Block_ID=block, Storage_Level=level)
    return _line(updates, tables.BLOCK_UPDATED, seq=c("seq"), Block_Updated_Info=info)


def all_lines(t: LogTables) -> DataFrame:
    """Every table as one set of event lines."""
    parts = [
        task_lines(t.tasks),
        stage_lines(t.stages),
        application_lines(t.applications),
        executor_lines(t.executors),
        removal_lines(t.removals),
        job_lines(t.jobs),
        scan_lines(t.scans),
        update_lines(t.updates),
    ]
    return reduce(DataFrame.union, parts)
