"""Detector queries, the typed log tables, and the findings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewright.operators import detectors, labels, timeline
from tracewright.operators.quantiles import grouped_quantiles
from tracewright.plans import task_tables as given
from tracewright.plans.registry import query, table
from tracewright.session import scratch_path
from tracewright.sources import tables
from tracewright.sources.lines import stage_events
from tracewright.sources.reports import fired_tags_of_findings

STAGE = "log_id, stage_id, stage_attempt"

SKEW = f"""
SELECT {STAGE}, n_tasks, median, round(upper, 6) AS p95, round(upper / median, 6) AS ratio,
  coalesce(upper / median >= 3 AND n_tasks >= 2, false) AS fires
FROM (SELECT {STAGE}, count(*) AS n_tasks, quantile_cont(duration_ms, 0.5) AS median,
    quantile_cont(duration_ms, 0.95) AS upper
  FROM tasks WHERE NOT failed AND NOT killed GROUP BY {STAGE})
"""
STRAGGLER = f"""
SELECT {STAGE}, n_tasks, n_stragglers, waste_ms, log_ms,
  n_stragglers / n_tasks > 0.025 AND waste_ms / log_ms > 0.005 AS fires
FROM (SELECT {STAGE}, count(*) AS n_tasks, count(*) FILTER (duration_ms > 2 * median) AS n_stragglers,
    coalesce(sum(duration_ms - median) FILTER (duration_ms > 2 * median), 0) AS waste_ms
  FROM (SELECT *, quantile_cont(duration_ms, 0.5) OVER (PARTITION BY {STAGE}) AS median
        FROM tasks WHERE NOT failed AND NOT killed) GROUP BY {STAGE})
JOIN (SELECT log_id, sum(duration_ms)::BIGINT AS log_ms FROM tasks GROUP BY 1) USING (log_id)
"""


def peers_sql(unit: str, level: str) -> str:
    return f"""
SELECT {STAGE}, unit, n_tasks, level, peer_median, n_units, stage_tasks,
  coalesce(level / peer_median >= 2 AND stage_tasks >= 15 AND n_units >= 3, false) AS fires
FROM (SELECT *, quantile_cont(level, 0.5) OVER w AS peer_median, count(*) OVER w AS n_units,
    sum(n_tasks) OVER w ::BIGINT AS stage_tasks
  FROM (SELECT {STAGE}, {unit} AS unit, count(*) AS n_tasks, {level}::DOUBLE AS level FROM tasks
        WHERE NOT failed AND NOT killed GROUP BY {STAGE}, {unit}) WINDOW w AS (PARTITION BY {STAGE}))
"""


HOST = peers_sql("host", "quantile_cont(duration_ms, 0.5)").replace(
    "sum(n_tasks) OVER w ::BIGINT", "(sum(n_tasks) OVER w)::BIGINT"
)
LOAD = peers_sql("executor_id", "sum(shuffle_read_bytes)").replace(
    "sum(n_tasks) OVER w ::BIGINT", "(sum(n_tasks) OVER w)::BIGINT"
)
INDEX_CTE = f"""
indexes AS (SELECT {STAGE}, task_index, bool_or(speculative) AS copied, count(*) FILTER (killed) AS n_killed,
  coalesce(sum(duration_ms) FILTER (killed), 0) AS killed_ms, count(*) FILTER (failed) AS n_failed,
  coalesce(sum(duration_ms) FILTER (failed), 0) AS failed_ms,
  coalesce(max(attempt) FILTER (NOT failed AND NOT killed) > min(attempt) FILTER (failed), false) AS recovered
  FROM tasks GROUP BY {STAGE}, task_index)
"""
SPEC = f"""
SELECT {STAGE}, coalesce(sum(n_killed) FILTER (copied), 0)::BIGINT AS n_losers,
  coalesce(sum(killed_ms) FILTER (copied), 0)::BIGINT AS losers_ms,
  n_losers >= 5 AND losers_ms >= 60000 AS fires FROM indexes GROUP BY {STAGE}
"""
RETRY = f"""
SELECT {STAGE}, coalesce(sum(n_failed) FILTER (recovered), 0)::BIGINT AS n_retried,
  coalesce(sum(failed_ms) FILTER (recovered), 0)::BIGINT AS retried_ms,
  n_retried >= 3 AND retried_ms >= 30000 AS fires FROM indexes GROUP BY {STAGE}
"""
FAIL = f"""
SELECT {STAGE}, count(*) AS n_indexes, count(*) FILTER (n_failed > 0) AS n_failing,
  n_indexes >= 10 AND n_failing / n_indexes >= 0.05 AS fires FROM indexes GROUP BY {STAGE}
"""
SHFL = f"""
SELECT {STAGE}, sum(shuffle_write_bytes)::BIGINT AS shuffle_bytes, shuffle_bytes >= 52428800 AS fires
FROM tasks GROUP BY {STAGE}
"""
PART = f"""
SELECT {STAGE}, max(shuffle_read_bytes) AS max_read_bytes, max_read_bytes >= 268435456 AS fires
FROM tasks GROUP BY {STAGE}
"""
TINY = f"""
SELECT {STAGE}, count(*) AS n_tasks,
  count(*) FILTER (shuffle_read_bytes < 1048576 AND duration_ms < 100) AS n_tiny,
  n_tiny / n_tasks >= 0.5 AND n_tasks >= 200 AS fires FROM tasks GROUP BY {STAGE}
"""
SPILL = f"""
SELECT {STAGE}, sum(disk_spill_bytes)::BIGINT AS spill_bytes, spill_bytes > 0 AS fires
FROM tasks GROUP BY {STAGE}
"""
SFAIL = """
SELECT log_id, count(*) AS n_stages, count(failure_reason) AS n_failed, n_failed > 0 AS fires
FROM stages GROUP BY log_id
"""
JOBS = """
SELECT log_id, count(result) AS n_finished, count(*) FILTER (result = 'JobFailed') AS n_failed,
  n_failed > 0 AS fires FROM jobs GROUP BY log_id
"""
# Core time and task time from each executor's and task's own span; peaks and idle time
# from running sums over the moments.
UTIL = """
SELECT log_id, coalesce(busy_ms, 0)::BIGINT AS busy_ms, coalesce(room_ms, 0)::BIGINT AS room_ms,
  coalesce(peak_cores, 0)::BIGINT AS peak_cores, coalesce(peak_running, 0)::BIGINT AS peak_running,
  coalesce(idle_ms, 0)::BIGINT AS idle_ms,
  CASE WHEN coalesce(room_ms, 0) > 0 THEN coalesce(busy_ms, 0) / room_ms < 0.5 END AS fires
FROM applications
LEFT JOIN (SELECT log_id, sum(least(greatest(finish_ms, started_ms), fin) - least(greatest(launch_ms, started_ms), fin)) AS busy_ms
  FROM tasks JOIN bounds USING (log_id) GROUP BY 1) USING (log_id)
LEFT JOIN (SELECT log_id, sum(cores * (least(greatest(coalesce(removed_ms, fin), added_ms, started_ms), fin)
    - least(greatest(added_ms, started_ms), fin))) AS room_ms
  FROM executors LEFT JOIN removals USING (log_id, executor_id) JOIN bounds USING (log_id) GROUP BY 1) USING (log_id)
LEFT JOIN (SELECT log_id, max(c) AS peak_cores, max(r) AS peak_running,
    coalesce(sum(until - moment) FILTER (r < 0.5 * c), 0) AS idle_ms
  FROM (SELECT log_id, moment, sum(c) OVER w AS c, sum(r) OVER w AS r,
      coalesce(lead(moment) OVER w, fin) AS until
    FROM (SELECT log_id, least(greatest(moment, started_ms), fin) AS moment, sum(c) AS c, sum(r) AS r, any_value(fin) AS fin
      FROM moments JOIN bounds USING (log_id) GROUP BY 1, 2) WINDOW w AS (PARTITION BY log_id ORDER BY moment)) GROUP BY 1)
  USING (log_id)
"""
MOMENTS_CTE = """
moments AS (SELECT log_id, added_ms AS moment, cores AS c, 0 AS r FROM executors
  UNION ALL SELECT log_id, greatest(removed_ms, added_ms), -cores, 0 FROM removals JOIN executors USING (log_id, executor_id)
  UNION ALL SELECT log_id, launch_ms, 0, 1 FROM tasks UNION ALL SELECT log_id, finish_ms, 0, -1 FROM tasks),
bounds AS (SELECT log_id, started_ms, coalesce(ended_ms, last) AS fin FROM applications
  LEFT JOIN (SELECT log_id, max(moment) AS last FROM moments GROUP BY 1) USING (log_id))
"""
COLD = """
SELECT log_id, coalesce(first_executor, ended_ms) - first_stage AS wait_ms, wait_ms > 30000 AS fires
FROM applications
LEFT JOIN (SELECT log_id, min(added_ms) AS first_executor FROM executors GROUP BY 1) USING (log_id)
LEFT JOIN (SELECT log_id, min(submitted_ms) AS first_stage FROM stages GROUP BY 1) USING (log_id)
"""
CACHE = """
SELECT log_id, location, count(DISTINCT execution_id) AS n_executions, n_executions >= 2 AS fires
FROM scans GROUP BY 1, 2
"""
CSTOR = """
SELECT log_id, rdd_id, count(*) FILTER (m) AS n_in_memory, count(*) FILTER (d AND NOT m) AS n_on_disk,
  count(*) AS n_partitions, n_in_memory > 0 AND n_in_memory / n_partitions < 0.9 AS fires
FROM (SELECT log_id, rdd_id, partition, arg_max(in_memory, seq) AS m, arg_max(on_disk, seq) AS d
  FROM updates GROUP BY ALL) GROUP BY 1, 2
"""
INCMP = "SELECT log_id, n_ends, n_ends = 0 AS fires FROM applications"

T, S, A = given.TASKS_CTE, given.STAGES_CTE, given.APPS_CTE
E, J, C, U = given.EXECUTORS_CTE, given.JOBS_CTE, given.SCANS_CTE, given.UPDATES_CTE
R = given.REMOVALS_CTE


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


@query(
    "supplier_skew",
    """
SELECT n_name, s_name, n_lines, median, round(upper, 6) AS p95, round(upper / median, 6) AS ratio,
  coalesce(upper / median >= 3 AND n_lines >= 2, false) AS fires
FROM (SELECT l_suppkey, count(*) AS n_lines, quantile_cont(cents, 0.5) AS median, quantile_cont(cents, 0.95) AS upper
  FROM (SELECT l_suppkey, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem) GROUP BY 1)
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""",
)
def supplier_skew(spark: SparkSession, folder: str) -> DataFrame:
    """Line prices per supplier as a stage's task measures, with names."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    prices = table(spark, folder, "lineitem").select("l_suppkey", cents.alias("cents"))
    stats = grouped_quantiles(prices, ["l_suppkey"], "cents", {"median": 0.5, "p95": 0.95})
    # Quantiles first: the dimensions then join one row per supplier.
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")
    )
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    ratio = F.col("p95") / F.col("median")
    return (
        stats.join(supplier, "l_suppkey")
        .join(nation, "n_nationkey")
        .select(
            "n_name",
            "s_name",
            F.col("n_values").alias("n_lines"),
            "median",
            F.round("p95", 6).alias("p95"),
            F.round(ratio, 6).alias("ratio"),
            F.coalesce((ratio >= 3) & (F.col("n_values") >= 2), F.lit(False)).alias("fires"),
        )
    )


@query("detect_skew", with_ctes(T) + SKEW)
def detect_skew(spark: SparkSession, folder: str) -> DataFrame:
    found = detectors.detect_skew(given.line_tasks(spark, folder))
    return found.withColumns({c: F.round(c, 6) for c in ("p95", "ratio")})


@query("detect_straggler", with_ctes(T) + STRAGGLER)
def detect_straggler(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_straggler(given.line_tasks(spark, folder))


@query("detect_slow_host", with_ctes(T) + HOST)
def detect_slow_host(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_slow_host(given.line_tasks(spark, folder))


@query("detect_loaded_executor", with_ctes(T) + LOAD)
def detect_loaded_executor(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_loaded_executor(given.line_tasks(spark, folder))


@query("detect_spec_waste", with_ctes(T, INDEX_CTE) + SPEC)
def detect_spec_waste(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_spec_waste(given.line_tasks(spark, folder))


@query("detect_shuffle", with_ctes(T) + SHFL)
def detect_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_shuffle(given.line_tasks(spark, folder))


@query("detect_big_partition", with_ctes(T) + PART)
def detect_big_partition(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_big_partition(given.line_tasks(spark, folder))


@query("detect_tiny_tasks", with_ctes(T) + TINY)
def detect_tiny_tasks(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_tiny_tasks(given.line_tasks(spark, folder))


@query("detect_spill", with_ctes(T) + SPILL)
def detect_spill(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_spill(given.line_tasks(spark, folder))


@query("detect_retry", with_ctes(T, INDEX_CTE) + RETRY)
def detect_retry(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_retry(given.line_tasks(spark, folder))


@query("detect_task_failures", with_ctes(T, INDEX_CTE) + FAIL)
def detect_task_failures(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_task_failures(given.line_tasks(spark, folder))


@query("detect_utilization", with_ctes(T, S, A, E, R, MOMENTS_CTE) + UTIL)
def detect_utilization(spark: SparkSession, folder: str) -> DataFrame:
    t = given.direct_tables(spark, folder)
    return detectors.detect_utilization(t.tasks, t.executors, t.applications, removals=t.removals)


@query("detect_cold_start", with_ctes(S, A, E) + COLD)
def detect_cold_start(spark: SparkSession, folder: str) -> DataFrame:
    t = given.direct_tables(spark, folder)
    return detectors.detect_cold_start(t.executors, t.stages, applications=t.applications)


@query("detect_rescan", with_ctes(C) + CACHE)
def detect_rescan(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_rescan(given.order_scans(spark, folder))


@query("detect_partial_cache", with_ctes(U) + CSTOR)
def detect_partial_cache(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_partial_cache(given.event_updates(spark, folder))


@query("detect_stage_failures", with_ctes(S) + SFAIL)
def detect_stage_failures(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_stage_failures(given.supplier_stages(spark, folder))


@query("detect_job_failures", with_ctes(J) + JOBS)
def detect_job_failures(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.detect_job_failures(given.order_jobs(spark, folder))


@query("detect_incomplete", with_ctes(S, A) + INCMP)
def detect_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    stages = given.supplier_stages(spark, folder)
    return detectors.detect_incomplete(given.stage_applications(stages))


# The typed tables, each from event lines rendered out of a given table.


@query("log_tasks", with_ctes(T) + "SELECT * FROM tasks")
def log_tasks(spark: SparkSession, folder: str) -> DataFrame:
    return tables.tasks(given.task_lines(given.line_tasks(spark, folder)))


@query("log_stages", with_ctes(S) + "SELECT * FROM stages")
def log_stages(spark: SparkSession, folder: str) -> DataFrame:
    return tables.stages(given.stage_lines(given.supplier_stages(spark, folder)))


@query("log_jobs", with_ctes(J) + "SELECT * FROM jobs")
def log_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return tables.jobs(given.job_lines(given.order_jobs(spark, folder)))


@query(
    "job_labels",
    with_ctes(J) + "SELECT log_id, job_id, CASE WHEN job_id % 3 <> 0 THEN 'order ' || job_id::VARCHAR END AS description FROM jobs",
)
def job_labels(spark: SparkSession, folder: str) -> DataFrame:
    return tables.job_labels(given.job_lines(given.order_jobs(spark, folder))).drop("tags")


@query("log_executors", with_ctes(E) + "SELECT * FROM executors")
def log_executors(spark: SparkSession, folder: str) -> DataFrame:
    return tables.executors(given.executor_lines(given.customer_executors(spark, folder)))


@query("log_removals", with_ctes(E, R) + "SELECT * FROM removals")
def log_removals(spark: SparkSession, folder: str) -> DataFrame:
    removed = given.executor_removals(given.customer_executors(spark, folder))
    return tables.removals(given.removal_lines(removed))


@query("core_timeline", with_ctes(T, S, A, E, R, MOMENTS_CTE) + """
SELECT log_id, moment AS at_ms, coalesce(lead(moment) OVER w, fin) AS until_ms, (sum(c) OVER w)::BIGINT AS cores,
  (sum(r) OVER w)::BIGINT AS running
FROM (SELECT log_id, least(greatest(moment, started_ms), ended_ms) AS moment, sum(c) AS c, sum(r) AS r,
    coalesce(any_value(ended_ms), max(moment)) AS fin
  FROM moments LEFT JOIN applications USING (log_id) GROUP BY 1, 2)
WINDOW w AS (PARTITION BY log_id ORDER BY moment)
""")
def core_timeline(spark: SparkSession, folder: str) -> DataFrame:
    t = given.direct_tables(spark, folder)
    return timeline.core_timeline(t.tasks, t.executors, t.applications, t.removals)


@query("log_applications", with_ctes(S, A) + "SELECT * FROM applications")
def log_applications(spark: SparkSession, folder: str) -> DataFrame:
    stages = given.supplier_stages(spark, folder)
    return tables.applications(given.application_lines(given.stage_applications(stages)))


@query("log_file_scans", with_ctes(C) + "SELECT * FROM scans")
def log_file_scans(spark: SparkSession, folder: str) -> DataFrame:
    return tables.file_scans(given.scan_lines(given.order_scans(spark, folder)))


@query("log_block_updates", with_ctes(U) + "SELECT * FROM updates")
def log_block_updates(spark: SparkSession, folder: str) -> DataFrame:
    return tables.block_updates(given.update_lines(given.event_updates(spark, folder)))


# Everything together: lines of all classes in, findings out.

CHECKS = {
    "SKEW": [SKEW],
    "STRAG": [STRAGGLER],
    "HOST": [HOST, LOAD],
    "SHFL": [SHFL],
    "PART": [PART],
    "TINY": [TINY],
    "SPILL": [SPILL],
    "SPEC": [SPEC],
    "RETRY": [RETRY],
    "FAIL": [FAIL],
    "UTIL": [UTIL],
    "COLD": [COLD],
    "CACHE": [CACHE],
    "CSTOR": [CSTOR],
    "SFAIL": [SFAIL],
    "JOBS": [JOBS],
    "INCMP": [INCMP],
}
assert set(CHECKS) == set(detectors.TAGS)


def _outcome_sql(tag: str, checks: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT log_id, fires FROM ({sql})" for sql in checks)
    return f"SELECT log_id, '{tag}' AS tag, fires FROM ({rows})"


FINDINGS_CTE = with_ctes(T, S, A, E, R, MOMENTS_CTE, J, C, U, INDEX_CTE) + (
    ", outcomes AS ("
    + " UNION ALL ".join(_outcome_sql(tag, checks) for tag, checks in CHECKS.items())
    + f"""), findings AS (SELECT log_id, tag, CASE WHEN count(fires) > 0 THEN bool_or(fires) END AS fires,
  count(*) FILTER (fires)::VARCHAR || '/' || count(fires)::VARCHAR AS evidence
  FROM (SELECT DISTINCT log_id FROM outcomes) CROSS JOIN (SELECT unnest({list(CHECKS)}) AS tag)
  LEFT JOIN outcomes USING (log_id, tag) GROUP BY 1, 2) """
)


def parsed_findings(spark: SparkSession, folder: str) -> DataFrame:
    lines = given.all_lines(given.direct_tables(spark, folder))
    staged = stage_events(lines, scratch_path(spark, "events"))
    found = tables.stored(tables.log_tables(staged), scratch_path(spark, "tables"))
    return detectors.findings(found)


@query("findings", FINDINGS_CTE + "SELECT log_id, tag, fires, evidence FROM findings")
def findings(spark: SparkSession, folder: str) -> DataFrame:
    return parsed_findings(spark, folder)


@query("clean_checks", FINDINGS_CTE + "SELECT log_id, tag FROM findings WHERE NOT fires")
def clean_checks(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.clean_checks(detectors.findings(given.direct_tables(spark, folder)))


@query(
    "label_score_findings",
    FINDINGS_CTE
    + """,
targets AS (SELECT log_id AS id, list_filter(['SKEW', CASE WHEN bool_or(n_tasks > 32) THEN 'INCMP' END,
    CASE WHEN bool_or(failure_reason IS NOT NULL) THEN 'SFAIL' END, 'PART'], lambda x: x IS NOT NULL) AS targets
  FROM stages GROUP BY 1),
fired AS (SELECT log_id AS id, list(tag) FILTER (fires) AS fired FROM findings GROUP BY 1)
SELECT id, array_to_string(list_filter(targets, lambda x: NOT list_contains(coalesce(fired, []), x)), ',') AS missing
FROM targets JOIN fired USING (id)
""",
)
def label_score_findings(spark: SparkSession, folder: str) -> DataFrame:
    """Labels scored by our own detectors in place of analyzer reports."""
    inputs = given.direct_tables(spark, folder)
    targets = F.array(
        F.lit("SKEW"),
        F.when(F.bool_or(F.col("n_tasks") > 32), "INCMP"),
        F.when(F.bool_or(F.col("failure_reason").isNotNull()), "SFAIL"),
        F.lit("PART"),
    )
    entries = inputs.stages.groupBy(F.col("log_id").alias("id")).agg(
        F.lit("self-generated").alias("source"),
        F.array_compact(targets).alias("targets_detectors"),
    )
    fired = fired_tags_of_findings(detectors.findings(inputs))
    scores = labels.score_against_findings(entries, fired)
    return scores.select("id", F.array_join("missing", ",").alias("missing"))
