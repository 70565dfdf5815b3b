import pytest
from pyspark.sql import functions as F

from tracewright.operators import confs, labels, runs, scenarios, versions
from tracewright.sources.reports import listed_versions


@pytest.fixture(scope="module")
def table(spark):
    return runs.all_runs(runs.pinned_versions(spark)).cache()


def test_family_sizes(table):
    counts = {r.family: r.n_runs for r in runs.matrix_counts(table).collect()}
    assert counts == {"baseline": 12, "pairwise": 7, "failure": 4, "cache": 2, "event-log": 5, "dml": 5}


def test_ids_are_unique_and_families_disjoint(table):
    assert table.select("id").distinct().count() == 35
    assert runs.family_overlap(table).count() == 0


def test_ids_do_not_change_with_a_patch(spark):
    bumped = runs.pinned_versions(spark).withColumn("version", F.concat("line", F.lit(".99")))
    one = {r.id for r in runs.all_runs(bumped).collect()}
    assert one == {r.id for r in runs.all_runs(runs.pinned_versions(spark)).collect()}


def test_order_of_runs(table):
    ordered = table.orderBy("family_ordinal", "spark_version", "position").collect()
    assert [r.id for r in ordered[:4]] == [
        "spark-3.5-parquet-baseline", "spark-3.5-delta-baseline", "spark-3.5-iceberg-baseline",
        "spark-4.0-parquet-baseline",
    ]
    assert ordered[-1].id == "delta-concurrent-merge"


def test_label_counts(table):
    rows = table.collect()
    assert sum(len(r.targets_detectors) for r in rows) == 45
    pairwise = [r for r in rows if r.family == "pairwise"]
    assert sum(len(r.targets_detectors) for r in pairwise) == 38
    assert sum(len(r.known_misses) for r in pairwise) == 10
    assert labels.known_miss_violations(table).count() == 0


def test_pairwise_rows_cover_every_pair(table):
    domains = {a: sorted({str(v[i]) for v in runs.PAIRWISE.values()}) for i, a in enumerate(runs.AXES)}
    axes = runs.run_axes(table.where("family = 'pairwise'"))
    counts = [r.n_runs for r in runs.pairwise_coverage(axes, domains).collect()]
    assert len(counts) == 84 and min(counts) >= 1
    with_base = runs.run_axes(table.where("family = 'pairwise' OR id = 'spark-4.2-parquet-baseline'"))
    assert {r.n_runs for r in runs.pairwise_coverage(with_base, domains).collect()} == {2}


def test_settings(table):
    rows = {r.id: r for r in runs.run_settings(table).collect()}
    one = rows["pairwise-01"]
    assert one.settings["row_count"] == "50000000" and one.settings["payload_columns"] == "0"
    assert one.settings["second_action"] == "count" and one.settings["failure"] == "none"
    assert one.spark_confs == {
        "spark.default.parallelism": "20",
        "spark.speculation.minTaskRuntime": "12s",
        "spark.eventLog.logBlockUpdates.enabled": "true",
    }
    assert rows["pairwise-06"].spark_confs == {
        "spark.default.parallelism": "20", "spark.memory.fraction": "0.02",
    }
    base = rows["spark-4.2-parquet-baseline"]
    assert base.settings["row_count"] == "5000000" and base.spark_confs == {}
    assert base.event_log_confs == runs.DEFAULT_EVENT_LOG_CONFS
    assert rows["cache-memory-only"].spark_confs == runs.STORAGE_PRESSURE_CONFS
    assert rows["eventlog-lz4"].event_log_confs["spark.eventLog.compression.codec"] == "lz4"
    assert rows["eventlog-spark4-default"].event_log_confs == runs.ROLL_SIZE
    assert rows["delta-merge-sql"].settings["dml"] == "merge-sql"


def test_one_run_lacks_its_artifact(table):
    rows = {r.id: r for r in runs.artifacts_of_runs(table).collect()}
    assert [i for i, r in rows.items() if r.skipped] == ["spark-4.2-iceberg-baseline"]
    assert rows["spark-4.2-parquet-baseline"].artifact == ""
    assert rows["spark-3.5-delta-baseline"].artifact == "io.delta:delta-spark_2.12:3.2.0"
    with pytest.raises(Exception, match="no known iceberg artifact for line 4.2"):
        runs.artifacts_of_runs(table, strict=True).collect()


def test_all_detector_tags_are_covered(table):
    tags = {r.tag for r in labels.tag_coverage(table).collect()}
    assert tags == set(
        "SKEW STRAG HOST SPEC SHFL PART TINY SPILL UTIL COLD CACHE CSTOR RETRY FAIL SFAIL JOBS INCMP".split()
    )


def test_conf_layers(spark):
    df = spark.createDataFrame([({"a": "1", "b": "1"}, None, {"b": "2", "c": None})], "x map<string,string>, y map<string,string>, z map<string,string>")
    merged = confs.merge_confs(F.col("x"), F.col("y"), F.col("z"))
    row = df.select(merged.alias("m"), confs.conf_diff(merged, F.col("x")).alias("d")).first()
    assert row.m == {"a": "1", "b": "2", "c": None}
    assert row.d == {"b": "2", "c": None}


def test_newest_patch_is_numeric(spark):
    rows = [(3, 5, 9), (3, 5, 10), (4, 0, 1), (3, 10, 0)]
    found = versions.latest_patch_per_line(spark.createDataFrame(rows, "major int, minor int, patch int"))
    assert [tuple(r) for r in found.collect()] == [(3, 5, 10), (3, 10, 0), (4, 0, 1)]


def test_version_drift(spark):
    upstream = spark.createDataFrame([(3, 5, 2), (3, 5, 3), (4, 0, 0), (4, 1, 2)], "major int, minor int, patch int")
    pinned = spark.createDataFrame([("3.5", "3.5.3"), ("4.0", "4.0.1"), ("2.4", "2.4.8")], "line string, pinned string")
    found = versions.drift_message(versions.version_drift(pinned, upstream)).collect()
    assert sorted(r.message for r in found) == [
        "2.4: pinned 2.4.8 is not on the dist listing",
        "4.0: pinned 4.0.1 is not on the dist listing",
        "4.0: pinned 4.0.1, upstream has 4.0.0",
        "4.1: not pinned, upstream has 4.1.2",
    ]


def test_no_drift(spark):
    upstream = spark.createDataFrame([(3, 5, 3)], "major int, minor int, patch int")
    pinned = spark.createDataFrame([("3.5", "3.5.3")], "line string, pinned string")
    assert versions.version_drift(pinned, upstream).count() == 0


def test_listing_without_versions_raises_when_strict(spark):
    page = spark.createDataFrame([("<html></html>",)], "html string")
    assert listed_versions(page).count() == 0
    with pytest.raises(Exception, match="no version directories"):
        listed_versions(page, strict=True).collect()


@pytest.mark.parametrize("run", ["pairwise-02", "pairwise-07", "cache-memory-only", "spark-4.2-parquet-baseline"])
def test_join_scenarios_run(spark, table, tmp_path, run):
    settings = {r.id: r.settings for r in runs.run_settings(table).collect()}[run]
    small = {**settings, "row_count": "3000", "shuffle_partitions": "4"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = str(tmp_path / "out")
    found = scenarios.run_scenario(spark, small, out)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.read.parquet(out).count() == 3000
    if settings["second_action"] == "count":
        assert found.first().n_rows == 3000
    elif settings["second_action"] == "reread":
        assert found.agg(F.sum("n_rows")).first()[0] == 3000


@pytest.mark.parametrize("mode", runs.DML_MODES)
def test_dml_scenarios_pass_their_checks(spark, table, tmp_path, mode):
    settings = {r.id: r.settings for r in runs.run_settings(table).collect()}[f"delta-{mode}"]
    small = {**settings, "row_count": "2000", "shuffle_partitions": "4"}
    checks = scenarios.run_scenario(spark, small, str(tmp_path / "table")).collect()
    assert checks and all(c.ok for c in checks)


def test_failing_runs_are_refused(spark, table, tmp_path):
    settings = {r.id: r.settings for r in runs.run_settings(table).collect()}["failure-job"]
    with pytest.raises(ValueError):
        scenarios.run_scenario(spark, settings, str(tmp_path / "x"))
