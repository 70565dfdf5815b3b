import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import catalog


def entries(spark, *ids, **fields):
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    return rows.withColumns({k: F.lit(v) for k, v in fields.items()})


def test_absent_catalog_is_empty(spark, tmp_path):
    assert catalog.load_catalog(spark, str(tmp_path / "none.json")).count() == 0


def test_json_array_catalog(spark, tmp_path):
    path = tmp_path / "index.json"
    path.write_text(json.dumps([{"id": "a", "size_bytes": 3, "known_misses": {"X": "y"}}, {"id": "b"}]))
    rows = catalog.load_catalog(spark, str(path), json_array=True).orderBy("id").collect()
    assert [(r.id, r.size_bytes, r.known_misses) for r in rows] == [("a", 3, {"X": "y"}), ("b", None, None)]


def test_saved_catalog_omits_nulls_and_sorts_keys(spark, tmp_path):
    path = str(tmp_path / "catalog")
    saved = entries(spark, "a", path="logs/a.ndjson").withColumn("license", F.lit(None).cast("string"))
    catalog.save_catalog(saved, path)
    assert spark.read.text(path).first()[0] == '{"id":"a","path":"logs/a.ndjson"}'
    assert [r.id for r in catalog.load_catalog(spark, path).collect()] == ["a"]


def test_a_loaded_catalog_is_saved_where_it_was(spark, tmp_path):
    path = str(tmp_path / "catalog")
    catalog.save_catalog(entries(spark, "a", unknown="kept", path="x"), path)
    loaded = catalog.load_catalog(spark, path)
    catalog.save_catalog(catalog.append_entries(loaded, entries(spark, "b")), path)
    rows = {r.id: r for r in catalog.load_catalog(spark, path).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].unknown == "kept"
    fired = spark.createDataFrame([("b", ["SKEW"])], "id string, fired array<string>")
    catalog.save_catalog(catalog.enrich(catalog.load_catalog(spark, path), fired, "v1"), path)
    rows = {r.id: r for r in catalog.load_catalog(spark, path).collect()}
    assert rows["b"].fires_detectors == ["SKEW"] and rows["a"].unknown == "kept"


def test_a_failed_save_leaves_the_old_catalog(spark, tmp_path):
    path = tmp_path / "catalog"
    catalog.save_catalog(entries(spark, "a"), str(path))
    broken = catalog.load_catalog(spark, str(path)).withColumn("path", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        catalog.save_catalog(broken, str(path))
    assert [r.id for r in catalog.load_catalog(spark, str(path)).collect()] == ["a"]
    # Cut short between the two renames.
    path.rename(tmp_path / "catalog.previous")
    assert [r.id for r in catalog.load_catalog(spark, str(path)).collect()] == ["a"]


def test_an_emptied_folder_is_no_catalog(spark, tmp_path):
    (tmp_path / "catalog").mkdir()
    with pytest.raises(FileNotFoundError):
        catalog.load_catalog(spark, str(tmp_path / "catalog"))


def test_append_skips_or_raises_on_duplicates(spark):
    old, new = entries(spark, "a", "b"), entries(spark, "b", "c")
    assert sorted(r.id for r in catalog.append_entries(old, new).collect()) == ["a", "b", "c"]
    assert [r.id for r in catalog.duplicates(new, old).collect()] == ["b"]
    assert [r.id for r in catalog.pending(new, old).collect()] == ["c"]
    with pytest.raises(Exception, match="already in the catalog: b"):
        catalog.append_entries(old, new, strict=True).collect()


def test_generation_tag_reuses_the_first_entry_or_dates_today(spark):
    rows = spark.createDataFrame([(1, "v2020-01-02"), (0, "v2019-05-06")], "n int, data_repo_tag string")
    assert catalog.generation_tag(rows, "n").first().tag == "v2019-05-06"
    today = spark.sql("SELECT date_format(current_date(), \"'v'yyyy-MM-dd\")").first()[0]
    assert catalog.generation_tag(rows.where("n > 5"), "n").first().tag == today


def test_external_ingest_decisions(spark):
    schema = "path string, name string, repo string, branch string, subpath string"
    paths = ["r/a-b/x.log", "r/a/x.log", "r/a/y.json", "r/a/z", "r/a/w"]
    files = spark.createDataFrame(
        [(p, p.split("/")[-1], "https://example.org/r.git", "main", "logs") for p in paths], schema
    )
    validity = spark.createDataFrame([("r/a/z", "bad event lines"), ("r/a/y.json", None)], "path string, reason string")
    known = entries(spark, "external-w")
    found = {r.path: r for r in catalog.external_ingest(files, validity, known).collect()}
    assert {p: r.status for p, r in found.items()} == {
        "r/a/x.log": "accepted",
        "r/a-b/x.log": "duplicate",
        "r/a/y.json": "accepted",
        "r/a/z": "invalid",
        "r/a/w": "known",
    }
    assert found["r/a/x.log"].source_url == "https://example.org/r/tree/main/logs/x.log"
    assert found["r/a/y.json"].dest == "logs/external/external-y.ndjson"
    stored = spark.createDataFrame([(p, "sha256:0", 1) for p in paths], "path string, checksum string, size_bytes long")
    rows = catalog.external_entries(
        catalog.external_ingest(files, validity, known), stored, F.lit("Apache-2.0"), F.lit("v2026-01-15")
    ).collect()
    assert sorted(r.id for r in rows) == ["external-x", "external-y"]
    assert {(r.source, r.fetched_at) for r in rows} == {("external", "2026-01-15")}


def test_crowded_stem_has_one_winner(spark):
    files = spark.range(5000).select(
        F.concat(F.lit("d"), "id", F.lit("/same.log")).alias("path"),
        F.lit("same.log").alias("name"),
        F.lit("r").alias("repo"), F.lit("b").alias("branch"), F.lit("s").alias("subpath"),
    )
    validity = files.select("path", F.lit(None).cast("string").alias("reason"))
    counts = dict(
        catalog.external_ingest(files, validity, entries(spark, "other")).groupBy("status").count().collect()
    )
    assert counts == {"accepted": 1, "duplicate": 4999}
