"""What the text operators share: narrow inputs, batches in tasks, fixed folds."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracewright.session import staged

#: Texts handled together inside a task, counted in bytes of text.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, binary: bool = False) -> DataFrame:
    """Only ``(doc_id, text)``, whatever else ``docs`` has and however it names them."""
    text = docs[text_col].cast("string")
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (text.cast("binary") if binary else text).alias("text"),
    )


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it; Spark ignores case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: str | Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null ids are in no fold."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def share(column: Column) -> Column:
    """A number in [0, 1) hashed from ``column``, the same in every run."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) / float(1 << 30)


def chunks(batches: Iterable[pa.RecordBatch], most: int = CHUNK_BYTES) -> Iterator[tuple[list, list]]:
    """Ids and texts of the first two columns, about ``most`` bytes of text at a time."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for key, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            ids.append(key.as_py())
            texts.append(text)
            size += len(text) if text is not None else 0
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def hold(df: DataFrame, name: str = "held") -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder, so that a
    lost executor costs no earlier step, and Spark knows its size when it joins it."""
    return staged(df, name)
