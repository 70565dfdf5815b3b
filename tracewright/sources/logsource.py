"""Event logs as a Spark data source: ``spark.read.format("eventlog").load(folder)``.

Every log below the folder is read, in any encoding, single files and rolling
directories: ``log_id, path, file_index, split, ordinal, value, error``. A large file is
several partitions, cut where its blocks or frames begin. Filters that name logs by id
are answered by the listing: other logs' files are not opened. A file that cannot be
decoded gives a row with its ``error`` after the lines before the damage.

Planning lists the folder and reads block headers of files longer than ``chunkBytes``
in one process on the driver; for a corpus of very many large files
:func:`tracewright.sources.decode.decode_logs` does that in parallel.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tracewright.functions.text import CODEC_SUFFIX, MARKER_PREFIX, ROLLED_NAME
from tracewright.session import qualified, ship_package
from tracewright.sources.decode import CHUNK_BYTES, chunk_ranges, decoded_chunk
from tracewright.storage import resolve

FORMAT = "eventlog"
SCHEMA = "log_id string, path string, file_index long, split long, ordinal long, value string, error string"
_COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


@dataclass
class Chunk(InputPartition):
    """A byte range of one file."""

    log_id: str
    path: str
    file_index: int
    codec: str
    chunk: int
    begin: int
    finish: int
    error: str | None = None


_FIELDS = [field.name for field in fields(Chunk)]


def _codec(name: str) -> str:
    found = re.search(CODEC_SUFFIX, f"/{name}")
    return found[1] if found else "none"


class EventLogReader(DataSourceReader):
    def __init__(self, folder: str, chunk_bytes: int):
        self.folder = folder
        self.chunk_bytes = chunk_bytes
        self.wanted: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep what names logs by id; Spark applies the rest."""
        for found in filters:
            if isinstance(found, (EqualTo, In)) and found.attribute == ("log_id",):
                values = {found.value} if isinstance(found, EqualTo) else set(found.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield found

    def _files(self) -> Iterator[tuple[str, str, int, int]]:
        """Log, path, index and length of every file with event lines."""
        filesystem, base = resolve(self.folder)
        scheme = self.folder[: self.folder.index(base)] if base in self.folder else ""
        for entry in filesystem.get_file_info(fs.FileSelector(base)):
            if self.wanted is not None and entry.base_name not in self.wanted:
                continue
            if entry.is_file:
                if not entry.base_name.startswith((".", MARKER_PREFIX)):
                    yield entry.base_name, scheme + entry.path, 0, entry.size
                continue
            for inner in filesystem.get_file_info(fs.FileSelector(entry.path)):
                rolled = re.match(ROLLED_NAME, inner.base_name)
                if inner.is_file and rolled:
                    yield entry.base_name, scheme + inner.path, int(rolled[1]), inner.size

    def partitions(self) -> Sequence[Chunk]:
        found = []
        for log_id, path, index, length in sorted(self._files()):
            codec = _codec(posixpath.basename(path))
            error, ranges = None, [(0, length)]
            if length > self.chunk_bytes or codec == "snappy":
                try:
                    ranges = chunk_ranges(path, codec, self.chunk_bytes)
                except (OSError, ValueError, pa.ArrowException) as exc:
                    error = str(exc)
            found += [
                Chunk(log_id, path, index, codec, n, begin, finish, error)
                for n, (begin, finish) in enumerate(ranges)
            ]
        return found

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's only partition of a source that has none
            return
        for batch in decoded_chunk({name: getattr(partition, name) for name in _FIELDS}):
            values = batch.column("value").cast(pa.string())
            lines = batch.set_column(batch.schema.get_field_index("value"), "value", values)
            yield lines.select(_COLUMNS)


class EventLogSource(DataSource):
    """Options: the folder, and ``chunkBytes``, the encoded bytes of a partition."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> EventLogReader:
        if "path" not in self.options:
            raise ValueError("name the folder of the logs: load(folder)")
        return EventLogReader(self.options["path"], int(self.options.get("chunkBytes", CHUNK_BYTES)))


def read_logs(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The lines of all logs directly below ``folder``, with this source registered."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EventLogSource)
    return spark.read.format(FORMAT).option("chunkBytes", chunk_bytes).load(qualified(spark, folder))
