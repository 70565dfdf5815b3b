"""Statements on files: what they touch changes, the rest stays byte for byte."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tracewright.operators import dml, rewrite

SCHEMA = "id long, bucket long, value double, status string"


def snapshot(path):
    """Every data file with its bytes' digest and its time."""
    return {
        str(p.relative_to(path)): (hashlib.sha256(p.read_bytes()).hexdigest(), p.stat().st_mtime_ns)
        for p in path.rglob("*.parquet")
        if not any(part.startswith("_") for part in p.relative_to(path).parts)
    }


def rows(spark, path, schema=SCHEMA):
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(str(path)).collect())


@pytest.fixture
def table(spark, tmp_path):
    """A hundred files of fifty ids each."""
    path = tmp_path / "table"
    ids = spark.range(5000).repartitionByRange(100, "id")
    dml.seed_rows(ids).write.parquet(str(path))
    assert len(snapshot(path)) == 100
    return path


def test_merge_touches_the_files_with_matches(spark, table):
    before = snapshot(table)
    target = spark.read.schema(SCHEMA).parquet(str(table))
    near = [(i, i % 4, -1.0, "merged") for i in (2000, 2003)] + [(9000, 0, -1.0, "merged"), (None, 1, 0.0, "merged")]
    source = spark.createDataFrame(near, SCHEMA)
    wanted = sorted(((tuple(r)) for r in dml.merge(target, source, "id").collect()), key=str)
    done = rewrite.merge_files(spark, str(table), source, "id")
    after = snapshot(table)
    assert sorted(map(tuple, spark.read.schema(SCHEMA).parquet(str(table)).collect()), key=str) == wanted
    kept = {name for name in before if after.get(name) == before[name]}
    assert len(done.replaced) == len(before) - len(kept) <= 2
    assert set(done.written) == set(after) - kept and not list(table.glob("_rewrite-*"))


def test_update_and_delete(spark, table):
    schema = spark.createDataFrame([], SCHEMA).schema
    before, old = snapshot(table), rows(spark, table)
    rewrite.update_files(spark, str(table), schema, "id = 7 OR status IS NULL", {"status": "'updated'"})
    assert [r for r in rows(spark, table) if r[3] != "seed"] == [(*old[7][:3], "updated")]
    assert len(snapshot(table).items() & before.items()) == 99
    rewrite.delete_files(spark, str(table), schema, "id >= 100")
    assert [r[0] for r in rows(spark, table)] == list(range(100))
    assert rewrite.delete_files(spark, str(table), schema, "id > 10000").replaced == []
    rewrite.delete_files(spark, str(table), schema, "true")
    assert rows(spark, table) == []


def test_an_ambiguous_merge_changes_nothing(spark, table):
    before = snapshot(table)
    twice = spark.createDataFrame([(5, 1, 1.0, "merged"), (5, 1, 2.0, "merged")], SCHEMA)
    with pytest.raises(Exception, match="several source rows match key 5"):
        rewrite.merge_files(spark, str(table), twice, "id")
    assert snapshot(table) == before
    assert rewrite.settle(spark, str(table)) == 0
    assert not list(table.glob("_rewrite-*")) and snapshot(table) == before


@pytest.mark.parametrize("moved", [0, 1])
def test_a_decided_statement_is_finished(spark, table, monkeypatch, moved):
    """Broken off before or between its moves."""
    schema = spark.createDataFrame([], SCHEMA).schema

    def broken(spark, path, pending, replaced, written):
        for name in written[:moved]:
            (table / pending.rsplit("/", 1)[1] / name).rename(table / name)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rewrite, "_move_in", broken)
        with pytest.raises(OSError, match="lost"):
            rewrite.delete_files(spark, str(table), schema, "id % 1000 = 0")
    assert rewrite.settle(spark, str(table)) == 1
    assert [r[0] for r in rows(spark, table)] == [i for i in range(5000) if i % 1000]
    assert rewrite.settle(spark, str(table)) == 0


def test_partitions_with_odd_names(spark, tmp_path):
    path = str(tmp_path / "a table")
    schema = "id long, place string"
    data = spark.createDataFrame([(n, ("a b", "50%/é", None)[n % 3]) for n in range(9)], schema)
    data.repartition("place").write.partitionBy("place").parquet(path)
    source = spark.createDataFrame([(1, "50%/é"), (100, "new one")], schema)
    done = rewrite.merge_files(spark, path, source, ["id", "place"], ["place"])
    assert len(done.replaced) == 1 and len(done.written) >= 2
    found = sorted((r.id, r.place) for r in spark.read.schema(schema).parquet(path).collect())
    assert found == sorted([(n, ("a b", "50%/é", None)[n % 3]) for n in range(9)] + [(100, "new one")], key=lambda r: r[0])


def test_counts_come_with_the_write(spark, tmp_path):
    ids = spark.range(1000)
    counted = dml.observed_write(dml.seed_rows(ids), str(tmp_path / "t"), {"all": "true", "even": "id % 2 = 0"})
    assert {r.check_name: r.n for r in counted.collect()} == {"all": 1000, "even": 500}
    assert spark.read.parquet(str(tmp_path / "t")).where(F.col("id") % 2 == 0).count() == 500


def test_tasks_move_and_delete_the_files(spark, table, monkeypatch):
    """The driver asks Hadoop for the pending folder and the note only, not for each file."""
    schema, asked = spark.createDataFrame([], SCHEMA).schema, []
    found = rewrite.hadoop_path
    monkeypatch.setattr(rewrite, "hadoop_path", lambda s, path: asked.append(path) or found(s, path))
    done = rewrite.update_files(spark, str(table), schema, "id % 100 = 0", {"status": "'updated'"})
    assert len(done.replaced) == 50 and len(asked) < 10
    assert len(rows(spark, table)) == 5000
    # Nor do checksums of old files stay behind.
    assert not [name for name in done.replaced if (table / f".{name}.crc").exists()]
