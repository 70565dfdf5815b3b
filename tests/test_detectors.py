"""Thresholds and edge shapes of single detectors, on hand-made tables."""

import pytest

from tracewright.operators import detectors as d

TASK = dict(
    log_id="a", stage_id=1, stage_attempt=0, task_index=0, attempt=0, launch_ms=0, finish_ms=0,
    duration_ms=1000, executor_id="1", host="h1", speculative=False, failed=False, killed=False,
    shuffle_read_bytes=0, shuffle_write_bytes=0, disk_spill_bytes=0,
)
SCHEMA = """
log_id string, stage_id long, stage_attempt long, task_index long, attempt long, launch_ms long,
finish_ms long, duration_ms long, executor_id string, host string, speculative boolean, failed boolean,
killed boolean, shuffle_read_bytes long, shuffle_write_bytes long, disk_spill_bytes long
"""


def tasks(spark, *rows):
    full = [tuple({**TASK, "task_index": i, **r}.values()) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def fires(df):
    return df.first().fires


@pytest.mark.parametrize("slow, hit", [(3000, True), (2999, False)])
def test_skew_at_its_floor(spark, slow, hit):
    rows = [{"duration_ms": 1000}] * 17 + [{"duration_ms": slow}] * 3
    assert fires(d.detect_skew(tasks(spark, *rows))) is hit


def test_skew_needs_two_tasks_and_a_median(spark):
    assert fires(d.detect_skew(tasks(spark, {"duration_ms": 5}))) is False
    assert fires(d.detect_skew(tasks(spark, *[{"duration_ms": 0}] * 9, {"duration_ms": 99}))) is False


def test_skew_ignores_failed_and_killed_attempts(spark):
    rows = [{}] * 5 + [{"duration_ms": 90_000, "failed": True}, {"duration_ms": 90_000, "killed": True}]
    row = d.detect_skew(tasks(spark, *rows)).first()
    assert (row.n_tasks, row.fires) == (5, False)


def test_skew_by_bytes(spark):
    rows = [{"shuffle_read_bytes": 10}] * 8 + [{"shuffle_read_bytes": 100}] * 2
    assert fires(d.detect_skew(tasks(spark, *rows), measure="shuffle_read_bytes")) is True


@pytest.mark.parametrize("n, hit", [(39, True), (40, False)])
def test_straggler_share_must_exceed_its_floor(spark, n, hit):
    # One straggler of 40 tasks is exactly 2.5 percent.
    rows = [{}] * (n - 1) + [{"duration_ms": 2001}]
    row = d.detect_straggler(tasks(spark, *rows)).first()
    assert (row.n_stragglers, row.waste_ms, row.fires) == (1, 1001.0, hit)


def test_slow_host(spark):
    rows = [{"host": f"h{i % 3}", "duration_ms": 2000 if i % 3 == 0 else 1000} for i in range(15)]
    found = {r.unit: r.fires for r in d.detect_slow_host(tasks(spark, *rows)).collect()}
    assert found == {"h0": True, "h1": False, "h2": False}
    two = [{"host": f"h{i % 2}", "duration_ms": 5000 if i % 2 else 1000} for i in range(20)]
    assert not any(r.fires for r in d.detect_slow_host(tasks(spark, *two)).collect())
    assert not any(r.fires for r in d.detect_slow_host(tasks(spark, *rows[:14])).collect())


def test_loaded_executor(spark):
    rows = [{"executor_id": str(i % 3), "shuffle_read_bytes": 500 if i % 3 == 0 else 100} for i in range(15)]
    found = {r.unit: r.fires for r in d.detect_loaded_executor(tasks(spark, *rows)).collect()}
    assert found == {"0": True, "1": False, "2": False}


@pytest.mark.parametrize("n, ms, hit", [(5, 12_000, True), (4, 20_000, False), (5, 11_999, False)])
def test_speculation_waste(spark, n, ms, hit):
    rows = []
    for i in range(n):
        rows += [{"task_index": i, "killed": True, "duration_ms": ms}, {"task_index": i, "attempt": 1, "speculative": True}]
    rows.append({"task_index": 99, "killed": True, "duration_ms": 10**6})
    row = d.detect_spec_waste(tasks(spark, *rows)).first()
    assert (row.n_losers, row.losers_ms, row.fires) == (n, n * ms, hit)


@pytest.mark.parametrize("n, ms, hit", [(3, 10_000, True), (2, 20_000, False), (3, 9_999, False)])
def test_retries(spark, n, ms, hit):
    rows = []
    for i in range(n):
        rows += [{"task_index": i, "failed": True, "duration_ms": ms}, {"task_index": i, "attempt": 1}]
    rows.append({"task_index": 99, "failed": True, "duration_ms": 10**6})
    row = d.detect_retry(tasks(spark, *rows)).first()
    assert (row.n_retried, row.retried_ms, row.fires) == (n, n * ms, hit)


@pytest.mark.parametrize("n, bad, hit", [(20, 1, True), (21, 1, False), (9, 9, False), (10, 1, True)])
def test_task_failures(spark, n, bad, hit):
    rows = [{"task_index": i} for i in range(n)] + [{"task_index": i, "failed": True} for i in range(bad)]
    row = d.detect_task_failures(tasks(spark, *rows)).first()
    assert (row.n_indexes, row.n_failing, row.fires) == (n, bad, hit)


@pytest.mark.parametrize(
    "detector, column, floor",
    [
        (d.detect_shuffle, "shuffle_write_bytes", 50 << 20),
        (d.detect_big_partition, "shuffle_read_bytes", 256 << 20),
        (d.detect_spill, "disk_spill_bytes", 1),
    ],
)
def test_byte_floors(spark, detector, column, floor):
    assert fires(detector(tasks(spark, {column: floor}))) is True
    assert fires(detector(tasks(spark, {column: floor - 1}))) is False


def test_tiny_tasks(spark):
    small, big = {"duration_ms": 99}, {"duration_ms": 5000}
    assert fires(d.detect_tiny_tasks(tasks(spark, *[small] * 100, *[big] * 100))) is True
    assert fires(d.detect_tiny_tasks(tasks(spark, *[small] * 99, *[big] * 101))) is False
    assert fires(d.detect_tiny_tasks(tasks(spark, *[small] * 199))) is False


def test_thresholds_are_parameters(spark):
    found = d.detect_tiny_tasks(tasks(spark, {"duration_ms": 1}), d.Thresholds(tiny_min_tasks=1))
    assert fires(found) is True


def test_partial_cache_uses_the_last_update(spark):
    schema = "log_id string, rdd_id long, partition long, seq long, in_memory boolean, on_disk boolean"
    rows = [("a", 1, p, p, True, False) for p in range(20)]
    evicted = [("a", 1, p, 100 + p, False, False) for p in range(8)]
    disk = [("a", 2, p, p, False, True) for p in range(20)]
    full = [("a", 3, p, p, True, False) for p in range(20)]
    updates = spark.createDataFrame(evicted + rows + disk + full, schema)
    found = {r.rdd_id: (r.n_in_memory, r.n_on_disk, r.fires) for r in d.detect_partial_cache(updates).collect()}
    assert found == {1: (12, 0, True), 2: (0, 20, False), 3: (20, 0, False)}
    rdds = spark.createDataFrame([("a", 3, 40)], "log_id string, rdd_id long, n_partitions long")
    found = {r.rdd_id: (r.n_partitions, r.fires) for r in d.detect_partial_cache(updates, rdds).collect()}
    assert found == {1: (20, True), 2: (20, False), 3: (40, True)}


def test_rescan_counts_executions_not_scans(spark):
    schema = "log_id string, execution_id long, location string"
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", 2, "y"), ("b", 3, "x")]
    found = {(r.log_id, r.location): r.fires for r in d.detect_rescan(spark.createDataFrame(rows, schema)).collect()}
    assert found == {("a", "x"): False, ("a", "y"): True, ("b", "x"): False}


@pytest.mark.parametrize("wait, hit", [(30_001, True), (30_000, False), (-5, False)])
def test_cold_start(spark, wait, hit):
    executors = spark.createDataFrame([("a", 1000 + wait), ("a", 10**9)], "log_id string, added_ms long")
    stages = spark.createDataFrame([("a", 1000), ("a", 99_000)], "log_id string, submitted_ms long")
    row = d.detect_cold_start(executors, stages).first()
    assert (row.wait_ms, row.fires) == (wait, hit)


def test_cold_start_without_executors_or_stages(spark):
    """An executor that never came is waited for until the end; no stage, no wait."""
    executors = spark.createDataFrame([("b", 5)], "log_id string, added_ms long")
    stages = spark.createDataFrame([("a", 1000), ("c", 1000)], "log_id string, submitted_ms long")
    ends = [("a", 50_000), ("b", 99_000), ("c", None), ("d", None)]
    apps = spark.createDataFrame(ends, "log_id string, ended_ms long")
    found = {r.log_id: (r.wait_ms, r.fires) for r in d.detect_cold_start(executors, stages, applications=apps).collect()}
    assert found == {"a": (49_000, True), "b": (None, None), "c": (None, None), "d": (None, None)}


def test_utilization_without_end_event(spark):
    executors = spark.createDataFrame([("a", "1", 4, 0)], "log_id string, executor_id string, cores long, added_ms long")
    apps = spark.createDataFrame([("a", 0, None)], "log_id string, started_ms long, ended_ms long")
    work = tasks(spark, {"launch_ms": 0, "duration_ms": 1000, "finish_ms": 1000})
    row = d.detect_utilization(work, executors, apps).first()
    assert (row.busy_ms, row.room_ms, row.peak_cores, row.idle_ms, row.fires) == (1000, 4000, 4, 1000, True)


def test_failed_jobs_and_stages(spark):
    jobs = spark.createDataFrame([("a", "JobFailed"), ("a", "JobSucceeded"), ("b", None)], "log_id string, result string")
    assert {r.log_id: (r.n_finished, r.fires) for r in d.detect_job_failures(jobs).collect()} == {"a": (2, True), "b": (0, False)}
    stages = spark.createDataFrame([("a", "boom"), ("b", None)], "log_id string, failure_reason string")
    assert {r.log_id: r.fires for r in d.detect_stage_failures(stages).collect()} == {"a": True, "b": False}


def test_skew_and_stragglers_share_their_quantiles(spark, monkeypatch):
    """Stage quantiles are the costliest pass over the tasks: one for both, one for hosts."""
    from tracewright.sources.tables import LogTables

    of = tasks(spark, *[{"duration_ms": 1000}] * 17, *[{"duration_ms": 9000}] * 3)
    empty = {
        "stages": "log_id string, stage_id long, stage_attempt long, name string, n_tasks long, submitted_ms long, completed_ms long, failure_reason string",
        "jobs": "log_id string, job_id long, submitted_ms long, completed_ms long, result string",
        "executors": "log_id string, executor_id string, host string, cores long, added_ms long",
        "scans": "log_id string, execution_id long, location string",
        "updates": "log_id string, rdd_id long, partition long, seq long, in_memory boolean, on_disk boolean",
    }
    rest = {name: spark.createDataFrame([], schema) for name, schema in empty.items()}
    apps = spark.createDataFrame([("a", 0, 10_000, 1)], "log_id string, started_ms long, ended_ms long, n_ends long")
    asked = []
    real = d.grouped_quantiles
    monkeypatch.setattr(d, "grouped_quantiles", lambda rows, keys, *a: asked.append(tuple(keys)) or real(rows, keys, *a))
    found = {r.tag: (r.fires, r.evidence) for r in d.findings(LogTables(tasks=of, applications=apps, **rest)).collect()}
    assert asked == [d.STAGE, (*d.STAGE, "host")]
    assert found["SKEW"] == (fires(d.detect_skew(of)), "1/1")
    assert found["STRAG"] == (fires(d.detect_straggler(of)), "1/1")
