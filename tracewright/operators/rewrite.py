"""MERGE, UPDATE and DELETE that rewrite only the files they touch.

A statement first finds the files of a Parquet table that hold matching rows, reading
the condition's or key's columns with each row's file. Only those files are read in full,
changed and written anew; all others stay as they are, byte for byte.

The new files are written beside the table's, in a hidden folder of their own, with a
note of what they replace; then they move in and the old ones go. A statement that fails
before its note is complete leaves the table as it was; :func:`settle` finishes one that
failed after it. It is no transaction: a reader may see the table between the moves, and
statements that touch the same files must not run at once.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tracewright.operators import dml
from tracewright.session import hadoop_path, map_in_arrow, qualified, staged, task_count
from tracewright.storage import resolve

_PENDING = "_rewrite-"
_NOTE = "_replaced.json"
_FILE = "_file"
#: Names that one task moves or deletes.
NAMES_A_TASK = 256
#: Tasks move their files in themselves; else the driver does, one by one.
COMMIT_IN_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


@dataclass(frozen=True)
class Rewritten:
    """What a statement did: the files it replaced and those it wrote."""

    replaced: list[str]
    written: list[str]


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _with_file(table: DataFrame) -> DataFrame:
    return table.withColumn(_FILE, F.col("_metadata.file_path"))


def _files(rows: DataFrame) -> list[str]:
    """The distinct files of ``rows``: names only, as many as the table's listing has."""
    return sorted(unquote(r[0]) for r in rows.select(_FILE).distinct().collect())


def _rows_of(spark: SparkSession, path: str, files: Sequence[str], schema: StructType) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files)


def _listed(folder: str) -> list[str]:
    """Data files below ``folder``, hidden ones left out, relative to it."""
    filesystem, base = resolve(folder)
    found = filesystem.get_file_info(fs.FileSelector(base, recursive=True))
    names = [i.path[len(base) :].lstrip("/") for i in found if i.is_file]
    return sorted(n for n in names if not any(part.startswith(("_", ".")) for part in n.split("/")))


def _replace(new: DataFrame, path: str, files: Sequence[str], partition_by: Sequence[str]) -> Rewritten:
    """Write ``new`` and let it take the place of ``files``."""
    spark = new.sparkSession
    pending = f"{path}/{_PENDING}{uuid4().hex}"
    # Nothing counts before the note, so tasks may move their files in as they end.
    new.write.partitionBy(*partition_by).options(**COMMIT_IN_TASKS).parquet(pending)
    filesystem, _ = hadoop_path(spark, pending)
    written = _listed(qualified(spark, pending))
    base = qualified(spark, path).rstrip("/") + "/"
    plain = resolve(base)[1].rstrip("/") + "/"
    replaced = [resolve(f)[1].removeprefix(plain) for f in files]
    # Complete only under its final name: the statement counts from then on.
    draft, note = (hadoop_path(spark, f"{pending}/{name}")[1] for name in (f".{_NOTE}", _NOTE))
    stream = filesystem.create(draft)
    stream.write(json.dumps({"replaced": replaced, "written": written}).encode())
    stream.close()
    if not filesystem.rename(draft, note):
        raise OSError(f"cannot write {note.toString()}")
    _move_in(spark, path, pending, replaced, written)
    return Rewritten(replaced, written)


def _move_in(spark: SparkSession, path: str, pending: str, replaced: Sequence[str], written: Sequence[str]) -> None:
    """New files in, old ones out, and the folder last; may be repeated. Tasks move and
    delete, as there may be very many files."""
    root = qualified(spark, path).rstrip("/")
    inner = f"{root}/{pending.rstrip('/').rsplit('/', 1)[1]}"

    def mover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = resolve(root)
        beside = resolve(inner)[1]
        for batch in batches:
            for name in batch.column("name").to_pylist():
                if filesystem.get_file_info(f"{beside}/{name}").type != fs.FileType.NotFound:
                    filesystem.create_dir(posixpath.dirname(f"{base}/{name}"), recursive=True)
                    filesystem.move(f"{beside}/{name}", f"{base}/{name}")
            yield batch

    def remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = resolve(root)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                folder, file = posixpath.split(name)
                # Hadoop's local filesystem keeps a checksum beside a file.
                for old in (name, posixpath.join(folder, f".{file}.crc")):
                    if filesystem.get_file_info(f"{base}/{old}").type != fs.FileType.NotFound:
                        filesystem.delete_file(f"{base}/{old}")
            yield batch

    for names, function in ((written, mover), (replaced, remover)):
        if names:
            tasks = min(task_count(spark), -(-len(names) // NAMES_A_TASK))
            rows = spark.createDataFrame(pa.table({"name": pa.array(names, pa.string())})).repartition(tasks)
            map_in_arrow(rows, function, "name string").write.format("noop").mode("overwrite").save()
    filesystem, folder = hadoop_path(spark, pending)
    filesystem.delete(folder, True)


def settle(spark: SparkSession, path: str) -> int:
    """Finish the statements on ``path`` that failed after their decision, drop what
    others left half written, and return how many were finished. Call it when no
    statement is running."""
    filesystem, folder = hadoop_path(spark, path)
    finished = 0
    for status in filesystem.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith(_PENDING):
            continue
        pending = f"{path}/{name}"
        note = hadoop_path(spark, f"{pending}/{_NOTE}")[1]
        if not filesystem.exists(note):
            filesystem.delete(status.getPath(), True)
            continue
        stream = filesystem.open(note)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        _move_in(spark, path, pending, **json.loads(text))
        finished += 1
    return finished


def merge_files(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str | Sequence[str],
    partition_by: Sequence[str] = (),
) -> Rewritten:
    """:func:`tracewright.operators.dml.merge` on the table at ``path``, whose columns
    ``source`` has. Of the table's files, key columns are read from all and rows from
    those with a match; rows without one go to new files."""
    keys = [key] if isinstance(key, str) else list(key)
    table = read_table(spark, path, source.schema)
    matches = _with_file(table).select(*keys, _FILE).join(source.select(*keys).distinct(), keys, "left_semi")
    # Which keys matched, and where: both questions from one read.
    matched = staged(matches.distinct(), "matched")
    files = _files(matched)
    unique = dml.one_row_per_key(source, keys)
    updated = dml.updated(_rows_of(spark, path, files, table.schema), unique, keys)
    inserted = source.join(matched.select(*keys).distinct(), keys, "left_anti").select(*updated.columns)
    return _replace(updated.unionByName(inserted), path, files, partition_by)


def _where(
    spark: SparkSession,
    path: str,
    schema: StructType,
    condition: str,
    change: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str],
) -> Rewritten:
    files = _files(_with_file(read_table(spark, path, schema)).where(condition))
    return _replace(change(_rows_of(spark, path, files, schema)), path, files, partition_by)


def update_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    condition: str,
    assignments: Mapping[str, str],
    partition_by: Sequence[str] = (),
) -> Rewritten:
    """UPDATE on the table at ``path``; only files with a row to change are rewritten."""
    change = lambda rows: dml.update_where(rows, condition, assignments)
    return _where(spark, path, schema, condition, change, partition_by)


def delete_files(
    spark: SparkSession, path: str, schema: StructType, condition: str, partition_by: Sequence[str] = ()
) -> Rewritten:
    """DELETE on the table at ``path``; a file all of whose rows go is not replaced."""
    change = lambda rows: dml.delete_where(rows, condition)
    return _where(spark, path, schema, condition, change, partition_by)
