import pytest
from pyspark.sql import functions as F

from tracewright.operators import dml, workload

SCHEMA = "id long, bucket long, value double, status string"


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_updates_inserts_and_keeps(spark):
    target = rows(spark, (1, 1, 1.0, "seed"), (2, 2, 2.0, "seed"), (None, 0, 0.0, "seed"))
    source = rows(spark, (2, 2, None, "merged"), (3, 3, 3.0, "merged"), (None, 9, 9.0, "merged"))
    assert result(dml.merge(target, source, "id")) == result(
        rows(
            spark,
            (1, 1, 1.0, "seed"), (2, 2, None, "merged"), (3, 3, 3.0, "merged"),
            (None, 0, 0.0, "seed"), (None, 9, 9.0, "merged"),
        )
    )


def test_ambiguous_match_raises_and_new_copies_are_kept(spark):
    target = rows(spark, (1, 1, 1.0, "seed"))
    twice = rows(spark, (1, 1, 5.0, "merged"), (1, 1, 6.0, "merged"))
    with pytest.raises(Exception, match="several source rows match key 1"):
        dml.merge(target, twice, "id").collect()
    new = rows(spark, (7, 3, 5.0, "merged"), (7, 3, 6.0, "merged"))
    assert dml.merge(target, new, "id").count() == 3


def test_merge_without_broadcast_gives_the_same(spark):
    ids = spark.range(1000).withColumnRenamed("id", "id")
    target = dml.seed_rows(ids)
    source = dml.merge_source_rows(spark.range(1100), 1000)
    small = result(dml.merge(target, source, "id"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        assert result(dml.merge(target, source, "id")) == small
    finally:
        spark.conf.set(setting, before)
    assert len(small) == 1100


def test_null_conditions_change_nothing(spark):
    target = rows(spark, (1, None, 1.0, "seed"), (2, 2, 2.0, "seed"))
    updated = dml.update_where(target, "bucket = 2", {"status": "'updated'"})
    assert sorted(r.status for r in updated.collect()) == ["seed", "updated"]
    assert dml.delete_where(target, "bucket = 2").count() == 1


def test_update_reads_old_values(spark):
    target = rows(spark, (1, 5, 2.0, "seed"))
    row = dml.update_where(target, "true", {"bucket": "id", "id": "bucket"}).first()
    assert (row.id, row.bucket) == (5, 1)


def test_concurrent_merges_touch_their_buckets_only(spark, tmp_path):
    path, n = str(tmp_path / "table"), 1000
    dml.seed_table(spark.range(n), path)
    source = dml.merge_source_rows(spark.range(n + n // 10), n)
    dml.merge_partitions(spark, path, source, "id", "bucket", dml.CONCURRENT_BUCKETS)
    after = spark.read.schema(source.schema).parquet(path)
    merged = {r.bucket: r["count"] for r in after.where("status = 'merged'").groupBy("bucket").count().collect()}
    wanted = [i for i in range(n + n // 10) if i % 5 == 0 or i >= n]
    assert merged == {b: sum(i % 4 == b for i in wanted) for b in (0, 1)}
    assert after.where("bucket > 1").count() == 500


@pytest.mark.parametrize("n", [1, 7, 20, 99, 1000])
def test_postconditions_closed_forms(spark, n):
    source = [i for i in range(n + n // 10) if i % 5 == 0 or i >= n]
    wanted = {
        "merge total": n + n // 10,
        "merge merged": len(source),
        "update total": n,
        "update updated": len(range(0, n, 10)),
        "delete total": n - len(range(0, n, 4)),
        "concurrent merged": sum(i % 4 in (0, 1) for i in source),
    }
    found = {r.check_name: r.n for r in dml.expected_counts(spark.range(n)).collect()}
    assert found == wanted


def test_check_counts(spark):
    schema = "check_name string, n long"
    expected = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema)
    actual = spark.createDataFrame([("a", 1), ("b", 5)], schema)
    found = {r.check_name: r.ok for r in dml.check_counts([actual], expected).collect()}
    assert found == {"a": True, "b": False, "c": False}
    with pytest.raises(Exception, match="b: expected 2 rows, found 5|c: expected 3 rows"):
        dml.check_counts([actual], expected, strict=True).collect()


def test_builder_needs_both_clauses(spark):
    target = rows(spark, (1, 1, 1.0, "seed"))
    with pytest.raises(ValueError):
        dml.merge_into(target, target, "id").when_matched_update_all().execute()


def test_injected_skew_share(spark):
    fact = workload.fact_table(workload.id_range(spark, 20000), skew="injected")
    hot = fact.where("join_key = 0").count() / 20000
    assert 0.78 < hot < 0.82
    assert fact.agg(F.max("join_key")).first()[0] == 999


def test_random_draws(spark):
    fact = workload.fact_table(workload.id_range(spark, 100), 4, payload_columns=2, draws="random", seed=3)
    assert fact.columns == ["row_id", "join_key", "payload_0", "payload_1"]
    assert fact.where("join_key BETWEEN 0 AND 3 AND payload_0 < 1").count() == 100


@pytest.mark.parametrize("persist_mode", ["none", "memory-only", "memory-and-disk"])
@pytest.mark.parametrize("second_action, rows_wanted", [("none", 500), ("count", 1), ("reread", 10)])
def test_run_workload(spark, tmp_path, persist_mode, second_action, rows_wanted):
    fact = workload.fact_table(workload.id_range(spark, 500), cardinality=10)
    dims = [
        workload.Dimension(workload.dimension_table(workload.key_range(spark, 10), str(i)), "join_key")
        for i in range(2)
    ]
    found = workload.run_workload(
        fact, dims, str(tmp_path / "out"), persist_mode=persist_mode,
        second_action=second_action, staging_path=str(tmp_path / "fact"),
    )
    assert found.count() == rows_wanted
    joined = spark.read.parquet(str(tmp_path / "out"))
    assert joined.columns == ["join_key", "row_id", "attr_0", "attr_1"] and joined.count() == 500


@pytest.mark.parametrize("salts", [1, 4])
def test_bucketed_star_join_needs_no_exchange(spark, tmp_path, salts):
    """Also with a key that holds most rows, split over several buckets."""
    fact = workload.fact_table(workload.id_range(spark, 4000), 50, skew="injected", payload_columns=1)
    dims = [workload.Dimension(workload.dimension_table(workload.key_range(spark, 50), s), "join_key") for s in "ab"]
    staged_fact, staged_dims = workload.stage_star(
        fact, dims, ["row_id"], f"star_{salts}", str(tmp_path / "star"), buckets=8, salts=salts
    )
    joined = workload.bucketed_star_join(staged_fact, staged_dims)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    assert result(joined.select("row_id", "attr_a", "attr_b")) == result(
        workload.star_join(fact, dims).select("row_id", "attr_a", "attr_b")
    )
    if salts > 1:
        most = staged_fact.where("join_key = 0").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert most < 0.6 * staged_fact.where("join_key = 0").count()
    for name in ("fact", "dim_0", "dim_1"):
        spark.sql(f"DROP TABLE star_{salts}_{name}")
