"""Take third-party logs into the corpus as they arrive.

The batch job (:func:`tracewright.operators.corpus.ingest_external`) restarts by the ids
its catalog knows. Here Structured Streaming remembers which files were seen: its
checkpoint takes the place of listing and looking up everything again, and each
micro-batch decides on new files only. This is an addition of ours.

A micro-batch writes its entries and its refusals under its own number, so one that is
run again after a failure replaces what it left. Files count by path: a changed file
under an old path is not read again. Spark's file source passes over empty files, so
those are neither taken in nor reported, unlike in the batch job. Between micro-batches, as between runs of the batch
job, the first file of a name wins and later ones are known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewright.operators import corpus
from tracewright.operators.catalog import CATALOG_SCHEMA
from tracewright.functions.text import base_name
from tracewright.session import hadoop_path

# The columns of Spark's binary file source.
_FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
_REFUSED = "id STRING, reason STRING"


@dataclass(frozen=True)
class Origin:
    """Where the files of an inbox come from, as their entries say."""

    repo: str
    branch: str
    subpath: str
    license: str


@dataclass(frozen=True)
class Corpus:
    """The folders of a corpus that grows: stored logs under ``root``, entries and
    refusals of every micro-batch, and the stream's checkpoint."""

    root: str

    @property
    def entries(self) -> str:
        return f"{self.root}/entries"

    @property
    def refused(self) -> str:
        return f"{self.root}/refused"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def arriving(spark: SparkSession, inbox: str, at_once: int | None = None) -> DataFrame:
    """A stream of the files below ``inbox``: ``uri, name, length``.
    File contents are not read. ``at_once`` bounds the files of a micro-batch."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
    if at_once is not None:
        reader = reader.option("maxFilesPerTrigger", at_once)
    return reader.load(inbox).select(F.col("path").alias("uri"), base_name("path").alias("name"), "length")


def _batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What all micro-batches wrote to ``folder``, with their number ``batch``."""
    filesystem, place = hadoop_path(spark, folder)
    if not filesystem.exists(place):
        return spark.createDataFrame([], f"{schema}, batch LONG")
    read = spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder)
    number = F.regexp_extract("_metadata.file_path", r"/([0-9]+)/[^/]*$", 1).cast("long")
    return read.select("*", number.alias("batch"))


def entries(spark: SparkSession, corpus_folders: Corpus) -> DataFrame:
    """The catalog entries so far, and the ``batch`` that wrote each."""
    return _batches(spark, corpus_folders.entries, CATALOG_SCHEMA)


def refused(spark: SparkSession, corpus_folders: Corpus) -> DataFrame:
    """``id`` (the path), ``reason`` and ``batch`` of the files turned away so far."""
    return _batches(spark, corpus_folders.refused, _REFUSED)


def ingest_arrivals(
    files: DataFrame, folders: Corpus, origin: Origin, tag: Column, known: DataFrame | None = None
) -> StreamingQuery:
    """Start taking in what ``files`` (:func:`arriving`) has not delivered before, and
    stop when all of it is in. ``known`` are entries of another catalog."""
    columns = {n: F.lit(getattr(origin, n)) for n in ("repo", "branch", "subpath", "license")}

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # What an earlier attempt of this batch wrote is not known to it.
        ours = entries(spark, folders).where(F.col("batch") < number).select("id")
        taken = ours if known is None else ours.union(known.select("id"))
        found = corpus.taken_in(batch.withColumns(columns), taken, tag, folders.root)
        found.entries.write.mode("overwrite").json(f"{folders.entries}/{number:012d}")
        found.quarantined.write.mode("overwrite").json(f"{folders.refused}/{number:012d}")

    return (
        files.writeStream.foreachBatch(commit)
        .option("checkpointLocation", folders.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
