"""Functions applied per partition, with its index and attempt number."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tracewright.session import map_in_arrow

PartitionFunction = Callable[[int, int, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_partitions(df: DataFrame, function: PartitionFunction, schema: str) -> DataFrame:
    """Apply ``function(partition index, attempt number, batches)`` to each
    partition's Arrow batches. Batches stream through; nothing is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        yield from function(context.partitionId(), context.attemptNumber(), batches)

    return map_in_arrow(df, run, schema)


def _profile(index: int, attempt: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sum(batch.num_rows for batch in batches)
    yield pa.RecordBatch.from_pydict(
        {"partition_id": [index], "attempt": [attempt], "n_rows": [rows]}
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition: ``partition_id, attempt, n_rows``."""
    return map_partitions(df, _profile, "partition_id long, attempt long, n_rows long")
