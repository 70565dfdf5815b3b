"""Bottleneck detectors over the tables of :mod:`tracewright.sources.tables`.

Each returns every group it looked at with the evidence it measured and a
``fires`` flag. Thresholds marked "ours" have no published floor. Times are
milliseconds. Sums and counts combine map-side, so a stage that holds a large
share of all tasks costs no more than others; quantiles never buffer a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tracewright.operators.quantiles import grouped_quantiles
from tracewright.operators.timeline import core_timeline, core_use
from tracewright.session import staged
from tracewright.sources.tables import LogTables

STAGE = ("log_id", "stage_id", "stage_attempt")
MIB = 1 << 20


@dataclass(frozen=True)
class Thresholds:
    skew_ratio: float = 3.0
    skew_min_tasks: int = 2  # ours
    straggler_factor: float = 2.0  # ours
    straggler_share: float = 0.025
    straggler_waste: float = 0.005
    host_ratio: float = 2.0  # ours
    host_min_tasks: int = 15
    host_min_units: int = 3
    spec_losers: int = 5
    spec_ms: int = 60_000
    shuffle_bytes: int = 50 * MIB
    partition_bytes: int = 256 * MIB
    tiny_bytes: int = MIB  # ours
    tiny_ms: int = 100  # ours
    tiny_share: float = 0.5  # ours
    tiny_min_tasks: int = 200  # ours
    spill_bytes: int = 0  # ours: any spill above this
    utilization: float = 0.5  # ours
    cold_ms: int = 30_000
    rescans: int = 2
    cached_share: float = 0.9
    retry_attempts: int = 3
    retry_ms: int = 30_000
    fail_min_tasks: int = 10
    fail_share: float = 0.05
    failed_jobs: float = 0.0  # ours: any failed share above this


DEFAULTS = Thresholds()


def _succeeded() -> Column:
    return ~F.col("failed") & ~F.col("killed")


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


# Skew and stragglers: quantiles of task time per stage.


def stage_quantiles(tasks: DataFrame, measure: str = "duration_ms") -> DataFrame:
    """Median and P95 of a measure over each stage's successful tasks."""
    return grouped_quantiles(
        tasks.where(_succeeded()), STAGE, measure, {"median": 0.5, "p95": 0.95}
    )


def detect_skew(
    tasks: DataFrame, t: Thresholds = DEFAULTS, measure: str = "duration_ms"
) -> DataFrame:
    """SKEW: P95 over median of a stage's tasks. Pass
    ``measure="shuffle_read_bytes"`` where task times are missing."""
    return _skew(stage_quantiles(tasks, measure), t)


def _skew(stats: DataFrame, t: Thresholds) -> DataFrame:
    ratio = F.when(F.col("median") > 0, F.col("p95") / F.col("median"))
    return stats.select(
        *STAGE,
        F.col("n_values").alias("n_tasks"),
        "median",
        "p95",
        ratio.alias("ratio"),
        F.coalesce(
            (ratio >= t.skew_ratio) & (F.col("n_values") >= t.skew_min_tasks), F.lit(False)
        ).alias("fires"),
    )


def detect_straggler(
    tasks: DataFrame, t: Thresholds = DEFAULTS, medians: DataFrame | None = None
) -> DataFrame:
    """STRAG: share of a stage's tasks far above its median, and the time they
    waste as a share of all task time of the log. ``medians`` are those of
    :func:`stage_quantiles`, written out, where they are known."""
    timed = tasks.where(_succeeded() & F.col("duration_ms").isNotNull())
    # One row a stage: Spark broadcasts it if its size allows, else splits hot stages.
    if medians is None:
        medians = staged(grouped_quantiles(timed, STAGE, "duration_ms", {"median": 0.5}), "medians")
    joined = timed.join(medians.select(*STAGE, "median"), list(STAGE))
    late = (F.col("median") > 0) & (F.col("duration_ms") > t.straggler_factor * F.col("median"))
    per_stage = joined.groupBy(*STAGE).agg(
        F.count("*").alias("n_tasks"),
        F.count_if(late).alias("n_stragglers"),
        F.sum(F.when(late, F.col("duration_ms") - F.col("median")).otherwise(0.0)).alias("waste_ms"),
    )
    totals = tasks.groupBy("log_id").agg(F.sum("duration_ms").alias("log_ms"))
    share = F.col("n_stragglers") / F.col("n_tasks")
    waste = F.when(F.col("log_ms") > 0, F.col("waste_ms") / F.col("log_ms"))
    fires = (share > t.straggler_share) & (_or_zero(waste) > t.straggler_waste)
    return per_stage.join(totals, "log_id").select(
        *STAGE,
        "n_tasks",
        "n_stragglers",
        "waste_ms",
        "log_ms",
        fires.alias("fires"),
    )


# Hosts: one unit (host or executor) far above its peers in a stage.


def _against_peers(per_unit: DataFrame, unit: str, t: Thresholds) -> DataFrame:
    """Compare each unit's ``level`` with the median over the stage's units;
    their number is that of the cluster's machines."""
    stage = per_unit.groupBy(*STAGE).agg(
        F.percentile("level", 0.5).alias("peer_median"),
        F.count("*").alias("n_units"),
        F.sum("n_tasks").alias("stage_tasks"),
    )
    ratio = F.when(F.col("peer_median") > 0, F.col("level") / F.col("peer_median"))
    fires = (
        (ratio >= t.host_ratio)
        & (F.col("stage_tasks") >= t.host_min_tasks)
        & (F.col("n_units") >= t.host_min_units)
    )
    return per_unit.join(stage, list(STAGE)).select(
        *STAGE,
        F.col(unit).alias("unit"),
        "n_tasks",
        "level",
        "peer_median",
        "n_units",
        "stage_tasks",
        F.coalesce(fires, F.lit(False)).alias("fires"),
    )


def detect_slow_host(tasks: DataFrame, t: Thresholds = DEFAULTS, unit: str = "host") -> DataFrame:
    """HOST by time: a unit's median task time against the stage's units."""
    medians = grouped_quantiles(
        tasks.where(_succeeded()), [*STAGE, unit], "duration_ms", {"level": 0.5}
    )
    return _against_peers(medians.withColumnRenamed("n_values", "n_tasks"), unit, t)


def detect_loaded_executor(
    tasks: DataFrame, t: Thresholds = DEFAULTS, unit: str = "executor_id"
) -> DataFrame:
    """HOST by load: shuffle bytes one executor reads against its peers."""
    loads = tasks.where(_succeeded()).groupBy(*STAGE, unit).agg(
        F.count("*").alias("n_tasks"),
        F.sum("shuffle_read_bytes").cast("double").alias("level"),
    )
    return _against_peers(loads, unit, t)


# Shuffle, partition size, task size, spill: plain stage aggregates.


def stage_profile(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Every additive measure of a stage in one pass."""
    tiny = (F.col("shuffle_read_bytes") < t.tiny_bytes) & (F.col("duration_ms") < t.tiny_ms)
    return tasks.groupBy(*STAGE).agg(
        F.count("*").alias("n_tasks"),
        F.sum("shuffle_write_bytes").alias("shuffle_bytes"),
        F.max("shuffle_read_bytes").alias("max_read_bytes"),
        F.sum("disk_spill_bytes").alias("spill_bytes"),
        F.count_if(tiny).alias("n_tiny"),
    )


def _shuffle_fires(t: Thresholds) -> Column:
    return F.col("shuffle_bytes") >= t.shuffle_bytes


def _partition_fires(t: Thresholds) -> Column:
    return F.col("max_read_bytes") >= t.partition_bytes


def _spill_fires(t: Thresholds) -> Column:
    return F.col("spill_bytes") > t.spill_bytes


def _tiny_fires(t: Thresholds) -> Column:
    share = F.col("n_tiny") / F.col("n_tasks")
    return (share >= t.tiny_share) & (F.col("n_tasks") >= t.tiny_min_tasks)


def detect_shuffle(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """SHFL: bytes a stage writes to shuffle."""
    profile = stage_profile(tasks, t)
    return profile.select(*STAGE, "shuffle_bytes", _shuffle_fires(t).alias("fires"))


def detect_big_partition(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """PART: the most shuffle bytes one task reads."""
    profile = stage_profile(tasks, t)
    return profile.select(*STAGE, "max_read_bytes", _partition_fires(t).alias("fires"))


def detect_tiny_tasks(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """TINY: share of a stage's tasks that read little and end at once."""
    profile = stage_profile(tasks, t)
    return profile.select(*STAGE, "n_tasks", "n_tiny", _tiny_fires(t).alias("fires"))


def detect_spill(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """SPILL: bytes a stage spills to disk."""
    profile = stage_profile(tasks, t)
    return profile.select(*STAGE, "spill_bytes", _spill_fires(t).alias("fires"))


# Speculation, retries, failures: attempts of one task index seen together.


def index_profile(tasks: DataFrame) -> DataFrame:
    """Attempt counts of each task index, rolled up to its stage."""
    of_index = tasks.groupBy(*STAGE, "task_index").agg(
        F.bool_or("speculative").alias("copied"),
        F.count_if(F.col("killed")).alias("n_killed"),
        F.sum(F.when(F.col("killed"), F.col("duration_ms")).otherwise(0)).alias("killed_ms"),
        F.count_if(F.col("failed")).alias("n_failed"),
        F.sum(F.when(F.col("failed"), F.col("duration_ms")).otherwise(0)).alias("failed_ms"),
        F.min(F.when(F.col("failed"), F.col("attempt"))).alias("first_failed"),
        F.max(F.when(_succeeded(), F.col("attempt"))).alias("last_success"),
    )
    recovered = F.coalesce(F.col("last_success") > F.col("first_failed"), F.lit(False))

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    return of_index.groupBy(*STAGE).agg(
        F.count("*").alias("n_indexes"),
        F.count_if(F.col("n_failed") > 0).alias("n_failing"),
        total(F.col("copied"), "n_killed").alias("n_losers"),
        total(F.col("copied"), "killed_ms").alias("losers_ms"),
        total(recovered, "n_failed").alias("n_retried"),
        total(recovered, "failed_ms").alias("retried_ms"),
    )


def _spec_fires(t: Thresholds) -> Column:
    return (F.col("n_losers") >= t.spec_losers) & (F.col("losers_ms") >= t.spec_ms)


def _retry_fires(t: Thresholds) -> Column:
    return (F.col("n_retried") >= t.retry_attempts) & (F.col("retried_ms") >= t.retry_ms)


def _fail_fires(t: Thresholds) -> Column:
    share = F.col("n_failing") / F.col("n_indexes")
    return (F.col("n_indexes") >= t.fail_min_tasks) & (share >= t.fail_share)


def detect_spec_waste(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """SPEC: killed attempts of task indexes that were copied, and their time.
    An attempt without an end event has no row and is not counted."""
    profile = index_profile(tasks)
    return profile.select(*STAGE, "n_losers", "losers_ms", _spec_fires(t).alias("fires"))


def detect_retry(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """RETRY: failed attempts of indexes that later succeed, and their time."""
    profile = index_profile(tasks)
    return profile.select(*STAGE, "n_retried", "retried_ms", _retry_fires(t).alias("fires"))


def detect_task_failures(tasks: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """FAIL: share of a stage's task indexes with a failed attempt."""
    profile = index_profile(tasks)
    return profile.select(*STAGE, "n_indexes", "n_failing", _fail_fires(t).alias("fires"))


# Whole-log detectors.


def detect_stage_failures(stages: DataFrame) -> DataFrame:
    """SFAIL: stages that ended with a failure reason."""
    per_log = stages.groupBy("log_id").agg(
        F.count("*").alias("n_stages"),
        F.count("failure_reason").alias("n_failed"),
    )
    return per_log.withColumn("fires", F.col("n_failed") > 0)


def detect_job_failures(jobs: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """JOBS: share of finished jobs that failed."""
    per_log = jobs.groupBy("log_id").agg(
        F.count("result").alias("n_finished"),
        F.count_if(F.col("result") != "JobSucceeded").alias("n_failed"),
    )
    share = F.when(F.col("n_finished") > 0, F.col("n_failed") / F.col("n_finished"))
    return per_log.withColumn("fires", _or_zero(share) > t.failed_jobs)


def detect_utilization(
    tasks: DataFrame,
    executors: DataFrame,
    applications: DataFrame,
    t: Thresholds = DEFAULTS,
    removals: DataFrame | None = None,
) -> DataFrame:
    """UTIL: task time over the core time that executors offered while they were
    there, per log of ``applications``. A log that never had a core is not checked:
    its ``fires`` is null. One without tasks used none of its cores."""
    use = core_use(core_timeline(tasks, executors, applications, removals), t.utilization)
    used = F.when(F.col("room_ms") > 0, F.col("busy_ms") / F.col("room_ms"))
    counts = ("busy_ms", "room_ms", "peak_cores", "peak_running", "idle_ms")
    return (
        applications.select("log_id")
        .join(use, "log_id", "left")
        .select("log_id", *[_or_zero(F.col(c)).alias(c) for c in counts], (used < t.utilization).alias("fires"))
    )


def detect_cold_start(
    executors: DataFrame, stages: DataFrame, t: Thresholds = DEFAULTS, applications: DataFrame | None = None
) -> DataFrame:
    """COLD: time from the first stage's submission to the first executor, for every
    log with a stage, and of ``applications`` if given. Where no executor came, the wait
    lasted to the application's end. A log without a stage, or without either, is not
    checked: its ``fires`` is null."""
    added = executors.groupBy("log_id").agg(F.min("added_ms").alias("first_executor_ms"))
    submitted = stages.groupBy("log_id").agg(F.min("submitted_ms").alias("first_stage_ms"))
    joined = submitted.join(added, "log_id", "left")
    ready = F.col("first_executor_ms")
    if applications is not None:
        ends = applications.select("log_id", "ended_ms")
        joined, ready = ends.join(joined, "log_id", "left"), F.coalesce(ready, F.col("ended_ms"))
    wait = ready - F.col("first_stage_ms")
    return joined.select("log_id", wait.alias("wait_ms"), (wait > t.cold_ms).alias("fires"))


def detect_rescan(scans: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """CACHE: SQL executions that scan one file location. Repeats of an
    execution collapse before the count, which then combines map-side."""
    once = scans.groupBy("log_id", "location", "execution_id").agg(F.lit(1).alias("_one"))
    per_location = once.groupBy("log_id", "location").agg(F.count("*").alias("n_executions"))
    return per_location.withColumn("fires", F.col("n_executions") >= t.rescans)


def detect_partial_cache(
    updates: DataFrame, rdds: DataFrame | None = None, t: Thresholds = DEFAULTS
) -> DataFrame:
    """CSTOR: cached share of an RDD's partitions by each one's last update.

    ``rdds`` (``log_id, rdd_id, n_partitions``) gives the partition count;
    without it, partitions ever updated are counted. A partition on disk only
    counts apart from those in memory.
    """
    # The state as a number keeps the aggregate a hash aggregate.
    state = F.col("in_memory").cast("int") + 2 * F.col("on_disk").cast("int")
    last = updates.groupBy("log_id", "rdd_id", "partition").agg(
        F.max_by(state, "seq").alias("last")
    )
    in_memory, on_disk = F.col("last") % 2 == 1, F.col("last") >= 2
    per_rdd = last.groupBy("log_id", "rdd_id").agg(
        F.count_if(in_memory).alias("n_in_memory"),
        F.count_if(on_disk & ~in_memory).alias("n_on_disk"),
        F.count("*").alias("n_seen"),
    )
    total = F.col("n_seen")
    if rdds is not None:
        per_rdd = per_rdd.join(rdds, ["log_id", "rdd_id"], "left")
        total = F.greatest("n_partitions", "n_seen")
    share = F.col("n_in_memory") / F.col("n_partitions")
    return (
        per_rdd.withColumn("n_partitions", total)
        .select("log_id", "rdd_id", "n_in_memory", "n_on_disk", "n_partitions")
        .withColumn("fires", (share > 0) & (share < t.cached_share))
    )


def detect_incomplete(applications: DataFrame) -> DataFrame:
    """INCMP: logs without an application-end event."""
    return applications.select("log_id", "n_ends", (F.col("n_ends") == 0).alias("fires"))


# All findings.

#: Every detector, in the order of a report.
TAGS = (
    "SKEW", "STRAG", "HOST", "SPEC", "SHFL", "PART", "TINY", "SPILL", "UTIL", "COLD", "CACHE", "CSTOR",
    "RETRY", "FAIL", "SFAIL", "JOBS", "INCMP",
)


def _rolled_up(tag: str, detected: DataFrame) -> DataFrame:
    return detected.groupBy("log_id").agg(
        F.lit(tag).alias("tag"),
        F.count_if("fires").alias("n_firing"),
        F.count("fires").alias("n_checked"),
    )


def _rolled_up_together(profile: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Several tags from one profile, read once."""
    flags = F.array(
        *[F.struct(F.lit(tag).alias("tag"), rule.alias("fires")) for tag, rule in rules.items()]
    )
    rows = profile.select("log_id", F.explode(flags).alias("f")).select("log_id", "f.*")
    return rows.groupBy("log_id", "tag").agg(
        F.count_if(F.coalesce("fires", F.lit(False))).alias("n_firing"),
        F.count("*").alias("n_checked"),
    )


def findings(tables: LogTables, t: Thresholds = DEFAULTS) -> DataFrame:
    """Every detector's outcome for every log: ``log_id, tag, fires, evidence``, where
    evidence counts the firing groups of those checked. Tags with ``fires`` false are
    the clean checks; those with null found nothing to check."""
    tasks = tables.tasks
    # SKEW and STRAG ask for the same stages' medians.
    quantiles = staged(stage_quantiles(tasks), "quantiles")
    outcomes = [
        _rolled_up("SKEW", _skew(quantiles, t)),
        _rolled_up("STRAG", detect_straggler(tasks, t, quantiles)),
        _rolled_up(
            "HOST", detect_slow_host(tasks, t).unionByName(detect_loaded_executor(tasks, t))
        ),
        _rolled_up_together(
            stage_profile(tasks, t),
            {
                "SHFL": _shuffle_fires(t),
                "PART": _partition_fires(t),
                "TINY": _tiny_fires(t),
                "SPILL": _spill_fires(t),
            },
        ),
        _rolled_up_together(
            index_profile(tasks),
            {"SPEC": _spec_fires(t), "RETRY": _retry_fires(t), "FAIL": _fail_fires(t)},
        ),
        _rolled_up(
            "UTIL",
            detect_utilization(tasks, tables.executors, tables.applications, t, tables.removals),
        ),
        _rolled_up(
            "COLD", detect_cold_start(tables.executors, tables.stages, t, tables.applications)
        ),
        _rolled_up("CACHE", detect_rescan(tables.scans, t)),
        _rolled_up("CSTOR", detect_partial_cache(tables.updates, tables.rdds, t)),
        _rolled_up("SFAIL", detect_stage_failures(tables.stages)),
        _rolled_up("JOBS", detect_job_failures(tables.jobs, t)),
        _rolled_up("INCMP", detect_incomplete(tables.applications)),
    ]
    columns = ["log_id", "tag", "n_firing", "n_checked"]
    united = tables.applications.select(
        "log_id", F.lit("").alias("tag"), *[F.lit(0).cast("long").alias(c) for c in columns[2:]]
    )
    for outcome in outcomes:
        united = united.unionByName(outcome.select(columns))
    # A row per tag and log at most: a log's outcomes are one small map.
    per_log = united.groupBy("log_id").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", F.struct("n_firing", "n_checked")))).alias("outcomes")
    )
    rows = per_log.select("log_id", "outcomes", F.explode(F.lit(list(TAGS))).alias("tag")).select(
        "log_id", "tag", F.try_element_at("outcomes", F.col("tag")).alias("o")
    )
    fires = F.when(F.col("o.n_checked") > 0, F.col("o.n_firing") > 0)
    evidence = F.concat_ws("/", *[_or_zero(F.col(f"o.{c}")).cast("string") for c in columns[2:]])
    return rows.select("log_id", "tag", fires.alias("fires"), evidence.alias("evidence"))


def clean_checks(found: DataFrame) -> DataFrame:
    """Checks that ran and found nothing."""
    return found.where(~F.col("fires")).select("log_id", "tag")
