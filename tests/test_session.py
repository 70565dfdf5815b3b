import pytest
from pyspark.sql import functions as F

from tracewright import session
from tracewright.operators import workload


@pytest.mark.parametrize(
    "text, size",
    [("10485760b", 10 << 20), ("-1", -1), ("12", 12), ("10MB", 10 << 20), ("2g", 2 << 30), ("7kb", 7 << 10)],
)
def test_broadcast_limit(spark, text, size):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, text)
    try:
        assert session.broadcast_limit(spark) == size
    finally:
        spark.conf.set(name, before)


def test_scratch_paths_lie_under_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or session.scratch_root(spark)
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and root.split(":")[-1].lstrip("/") in one


def test_staged_frames_are_computed_once(spark):
    draws = spark.range(50).withColumn("x", F.rand())
    kept = session.staged(draws, "draws")
    assert kept.collect() == kept.collect() and kept.count() == 50


def test_salts_follow_sizes(spark):
    ids = workload.id_range(spark, 1_000_000)
    small = workload.Dimension(workload.key_range(spark, 10), "join_key")
    large = workload.Dimension(workload.key_range(spark, 1_000_000), "join_key")
    assert workload.affordable_salts(ids, [small]) == session.task_count(spark)
    assert workload.affordable_salts(ids, [small, large]) == 1
