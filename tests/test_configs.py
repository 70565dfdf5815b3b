"""Configs with their types and nesting, in catalogs and in differences."""

import json

from pyspark.sql import functions as F

from tracewright.operators import catalog, confs, runs


def test_entries_keep_the_whole_config(spark, tmp_path):
    found = runs.all_runs(runs.pinned_versions(spark))
    configs = found.select("id", runs.run_config().alias("config_diff"))
    path = str(tmp_path / "catalog")
    catalog.save_catalog(configs, path)
    rows = {r.id: json.loads(r.c) for r in catalog.load_catalog(spark, path).select("id", F.to_json("config_diff").alias("c")).collect()}
    assert len(rows) == found.count()
    assert rows["spark-4.2-delta-baseline"] == {
        "aqe": True, "shuffle_partitions": 200, "dynamic_allocation": True, "speculation": False,
        "slow_host": False, "skew": "none", "caching": "none",
    }
    assert rows["pairwise-01"]["spark_confs"] == {
        "spark.default.parallelism": "20",
        "spark.speculation.minTaskRuntime": "12s",
        "spark.eventLog.logBlockUpdates.enabled": "true",
    }
    assert rows["pairwise-01"]["row_count"] == 50_000_000 and rows["pairwise-01"]["third_worker"] is True
    assert "event_log_confs" not in rows["pairwise-01"]
    assert rows["eventlog-lz4"]["event_log_confs"]["spark.eventLog.compression.codec"] == "lz4"
    assert rows["eventlog-spark4-default"]["event_log_confs"] == {"spark.eventLog.rolling.maxFileSize": "2m"}


def diff(spark, ours, base):
    df = spark.createDataFrame([(1, ours, base)], "id long, ours string, base string")
    parsed = df.select("id", F.parse_json("ours").alias("ours"), F.parse_json("base").alias("base"))
    return {"/".join(r.path): r.value for r in confs.typed_diff(parsed, "ours", "base").collect()}


def test_differences_by_type_and_depth(spark):
    ours = '{"a": true, "b": 1, "c": "1", "d": {"e": {"f": [1, 2]}, "g": null}, "h": {}, "same": {"x.y": "z"}}'
    base = '{"a": "true", "b": 1.0, "c": "1", "d": {"e": {"f": [1, 3]}}, "h": 0, "same": {"x.y": "z"}, "gone": 4}'
    found = diff(spark, ours, base)
    assert found.pop("b", "1") == "1"
    assert found == {"a": "true", "d/e/f": "[1,2]", "d/g": "null", "h": "{}"}
    assert diff(spark, base, base) == {}
    assert diff(spark, None, base) == {}
    assert diff(spark, '{"k": 1}', None) == {"k": "1"}
    assert diff(spark, "7", "8") == {"": "7"}


def test_typed_settings(spark):
    texts = {"t": "true", "n": "-12", "z": "0", "lead": "007", "big": "9" * 30, "word": "none", "float": "0.5", "no": None}
    df = spark.createDataFrame([(1, texts), (2, None)], "id long, config map<string,string>")
    rows = {r.id: json.loads(r.c) for r in df.select("id", F.to_json(runs.typed_config()).alias("c")).collect()}
    assert rows[1] == {**texts, "t": True, "n": -12, "z": 0}
    assert rows[2] == {}
