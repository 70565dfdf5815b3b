"""Logs that arrive in drops: each taken in once, as the batch job would."""

import pytest
from pyspark.sql import functions as F

from tracewright.operators import catalog, corpus
from tracewright.sources import files
from tracewright.streaming import ingest

GOOD = '{"Event":"a"}\n\n{"Event":"b"}\n'
ORIGIN = ingest.Origin("https://example.org/up.git", "main", "logs", "MIT")
TAG = "v2026-01-15"


def drop(inbox, **texts):
    inbox.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (inbox / name).write_text(text)


def take(spark, tmp_path, known=None, at_once=None):
    folders = ingest.Corpus(str(tmp_path / "corpus"))
    stream = ingest.arriving(spark, str(tmp_path / "inbox"), at_once)
    query = ingest.ingest_arrivals(stream, folders, ORIGIN, F.lit(TAG), known)
    query.awaitTermination()
    return folders


def names(df):
    return sorted((r.id.rsplit("/", 1)[-1], r.batch) for r in df.collect())


def test_two_drops_and_a_restart_equal_the_batch_job(spark, tmp_path):
    inbox = tmp_path / "inbox"
    drop(inbox, one=GOOD, bad="oops\n", known=GOOD)
    drop(inbox / "deeper", two=GOOD * 2)
    known = spark.createDataFrame([("external-known",)], "id string")
    folders = take(spark, tmp_path, known)
    assert names(ingest.entries(spark, folders)) == [("external-one", 0), ("external-two", 0)]
    # An empty file, which is passed over, and a name that is known by now.
    drop(inbox, three=GOOD, blank="\n", empty="")
    drop(inbox / "late", one=GOOD * 3)
    take(spark, tmp_path, known)
    assert names(ingest.entries(spark, folders)) == [("external-one", 0), ("external-three", 1), ("external-two", 0)]
    assert names(ingest.refused(spark, folders)) == [("bad", 0), ("blank", 1)]
    # Nothing new: nothing happens.
    take(spark, tmp_path, known)
    found = ingest.entries(spark, folders).drop("batch")
    assert found.count() == 3

    listing = files.list_logs(spark, [str(inbox)]).where("is_file").select(
        "uri", "name", *[F.lit(getattr(ORIGIN, n)).alias(n) for n in ("repo", "branch", "subpath", "license")]
    )
    empty = spark.createDataFrame([], catalog.CATALOG_SCHEMA)
    batch = corpus.ingest_external(
        listing, empty.unionByName(known, allowMissingColumns=True), F.lit(TAG), str(tmp_path / "batch")
    )
    columns = ["id", "path", "source_url", "license", "fetched_at"]
    ours = sorted(tuple(r) for r in found.where("id <> 'external-one'").select(*columns).collect())
    theirs = sorted(
        tuple(r) for r in batch.catalog.where("id NOT IN ('external-one', 'external-known')").select(*columns).collect()
    )
    assert ours == theirs
    for row in found.collect():
        stored = tmp_path / "corpus" / row.path
        assert stored.stat().st_size == row.size_bytes


def test_a_batch_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    drop(tmp_path / "inbox", one=GOOD, bad="oops\n")
    taken_in = corpus.taken_in
    with monkeypatch.context() as patch:
        calls = []

        def failing(*args):
            found = taken_in(*args)
            calls.append(found)
            # Entries are written by now, refusals are not.
            found.entries.write.mode("overwrite").json(f"{tmp_path}/corpus/entries/{0:012d}")
            raise RuntimeError("lost")

        patch.setattr(corpus, "taken_in", failing)
        with pytest.raises(Exception, match="lost"):
            take(spark, tmp_path)
        assert calls
    drop(tmp_path / "inbox", two=GOOD)
    folders = take(spark, tmp_path)
    assert names(ingest.entries(spark, folders)) == [("external-one", 0), ("external-two", 1)]
    assert names(ingest.refused(spark, folders)) == [("bad", 0)]


def test_bounded_batches(spark, tmp_path):
    drop(tmp_path / "inbox", **{f"log{n}": GOOD for n in range(5)})
    folders = take(spark, tmp_path, at_once=2)
    found = ingest.entries(spark, folders)
    assert found.count() == 5 and found.select("batch").distinct().count() == 3
