"""Cores and tasks over time against a walk over every millisecond."""

import random

import pytest

from tracewright.operators import detectors as d
from tracewright.operators.timeline import core_timeline

TASKS = "log_id string, launch_ms long, finish_ms long"
EXECUTORS = "log_id string, executor_id string, cores long, added_ms long"
REMOVALS = "log_id string, executor_id string, removed_ms long"
APPS = "log_id string, started_ms long, ended_ms long"


def frames(spark, tasks, executors, apps, removals):
    rows = ((tasks, TASKS), (executors, EXECUTORS), (apps, APPS), (removals, REMOVALS))
    return [spark.createDataFrame(r, s) for r, s in rows]


def walk(tasks, executors, apps, removals):
    """Room, use, peaks and idle time, counted millisecond by millisecond."""
    found = {}
    for log, start, end in apps:
        gone = {e: at for other, e, at in removals if other == log}
        mine = [(c, at, gone.get(e)) for other, e, c, at in executors if other == log]
        work = [(a, b) for other, a, b in tasks if other == log]
        if end is None:
            end = max([at for _, at, _ in mine] + [g for *_, g in mine if g is not None] + [b for _, b in work], default=start)
        cores = [sum(c for c, at, g in mine if at <= t and (g is None or t < max(g, at))) for t in range(start, end)]
        running = [sum(a <= t < b for a, b in work) for t in range(start, end)]
        room, busy = sum(cores), sum(running)
        idle = sum(r < 0.5 * c for c, r in zip(cores, running))
        found[log] = (busy, room, max(cores, default=0), idle, None if not room else busy / room < 0.5)
    return found


@pytest.mark.parametrize("bucket", [1, 7, 60_000])
def test_equals_a_walk(spark, bucket):
    draw = random.Random(bucket)
    apps = [("a", 10, 200), ("b", 0, None), ("none", 5, 50), ("idle", 0, 90), ("bare", 0, None)]
    executors = [(log, str(n), draw.randrange(1, 5), draw.randrange(0, 150)) for log in "ab" for n in range(6)]
    executors.append(("idle", "1", 2, 30))
    removals = [(log, str(n), draw.randrange(0, 220)) for log in "ab" for n in range(0, 6, 2)] + [("a", "ghost", 50)]
    starts = [(log, draw.randrange(0, 190)) for log in "ab" for _ in range(40)]
    tasks = [(log, at, at + draw.randrange(0, 30)) for log, at in starts] + [("none", 10, 20), ("a", None, 5)]
    given = frames(spark, tasks, executors, apps, removals)
    timeline = core_timeline(given[0], given[1], given[2], given[3], bucket)
    use = {r.log_id: r for r in d.core_use(timeline, 0.5).collect()}
    found = {
        r.log_id: (r.busy_ms, r.room_ms, use[r.log_id].peak_cores if r.log_id in use else 0, r.idle_ms, r.fires)
        for r in d.detect_utilization(*given[:3], removals=given[3]).collect()
    }
    wanted = walk([t for t in tasks if t[1] is not None], executors, apps, removals)
    # A peak of no length counts in the timeline, not in the walk.
    for log, row in wanted.items():
        assert found[log][:2] + found[log][3:] == row[:2] + row[3:], log
        assert found[log][2] >= row[2]
    rows = timeline.orderBy("log_id", "at_ms").collect()
    for before, after in zip(rows, rows[1:]):
        assert before.log_id != after.log_id or before.until_ms == after.at_ms


def test_removed_executor_makes_room_smaller(spark):
    tasks, executors = [("a", 0, 100)], [("a", "1", 1, 0), ("a", "2", 9, 0)]
    given = frames(spark, tasks, executors, [("a", 0, 1000)], [("a", "2", 10)])
    stays = d.detect_utilization(*given[:3]).first()
    leaves = d.detect_utilization(*given[:3], removals=given[3]).first()
    assert (stays.room_ms, leaves.room_ms) == (10_000, 1000 + 90)


def test_every_log_has_every_outcome(spark):
    """Also logs without executors, tasks or anything at all."""
    from tracewright.plans import task_tables as given
    from tracewright.sources.tables import LogTables

    whole = given.direct_tables(spark, "/root/testdata/sf0.001")
    bare = spark.createDataFrame([("bare", 0, 10, 1)], whole.applications.schema)
    fields = {k: getattr(whole, k) for k in LogTables.__dataclass_fields__}
    found = d.findings(LogTables(**{**fields, "applications": whole.applications.union(bare)})).collect()
    tags = {tag: (fires, evidence) for log, tag, fires, evidence in found if log == "bare"}
    assert set(tags) == set(d.TAGS)
    assert {t for t, (fires, _) in tags.items() if fires is not None} == {"INCMP"}
    assert tags["UTIL"] == (None, "0/0")
    assert all(sum(r.log_id == log for r in found) == len(d.TAGS) for log in {r.log_id for r in found})


def test_tasks_follow_the_size(spark, tmp_path):
    """Moments are dealt to more tasks as they grow, not merged into large ones."""
    from tracewright.operators import timeline

    small, large = (spark.range(n).selectExpr("'a' AS log_id", "id AS at_ms") for n in (1000, 20_000_000))
    least = spark.sparkContext.defaultParallelism
    assert timeline._parts(small) == least
    assert timeline._parts(large) > 8 * least


@pytest.mark.parametrize("bucket", [1, 7, 60_000])
def test_crowded_logs_are_cut_into_the_same_rows(spark, bucket):
    """Logs above the limit go by buckets, others and unlisted ones as a whole."""
    draw = random.Random(bucket)
    tasks = [(log, at, at + draw.randrange(0, 30)) for log in ("a", "b", "c", None) for at in draw.choices(range(190), k=40)]
    tasks += [("few", 3, 9), ("few", None, 5), ("late", 500, 600)]
    executors = [(log, str(n), n + 1, draw.randrange(0, 150)) for log in "abc" for n in range(5)] + [("idle", "1", 2, 30)]
    removals = [(log, "2", draw.randrange(0, 220)) for log in "ab"]
    apps = [("a", 10, 200), ("b", 0, None), ("few", 0, 20), ("late", 0, 100), ("idle", 0, 90)]
    given = frames(spark, tasks, executors, apps, removals)
    found = {
        limit: sorted(map(tuple, core_timeline(*given, bucket, limit).collect())) for limit in (0, 5, 44, 45, 1000)
    }
    assert found[0] and {log for log, *_ in found[0]} == {"a", "b", "c", "few", "late", "idle"}
    assert all(rows == found[0] for rows in found.values())


def test_whole_logs_need_no_sums_over_buckets(spark):
    """Where no log is crowded, the sums over buckets and their join are left out."""
    tasks = spark.range(500).selectExpr("concat('app-', id % 9) AS log_id", "id AS launch_ms", "id + 5 AS finish_ms")
    executors = spark.createDataFrame([("app-1", "1", 4, 0)], EXECUTORS)
    used = d.core_use(core_timeline(tasks, executors, spark.createDataFrame([("app-1", 0, 9000)], APPS)), 0.5)
    assert used.count() == 9
    used.collect()
    final = used._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # One for the running sums inside a log; buckets would have a window of their own.
    assert final.count("Window [") == 1
