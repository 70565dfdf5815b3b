"""Dense features of whole texts, and bounded samples of labelled rows."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracewright.llm.common import chunks, share
from tracewright.llm.repetition import duplicate_lines, measure
from tracewright.session import map_in_arrow

#: Labelled rows that a classifier is fitted on, at most about this many.
SAMPLE_ROWS = 12_000
#: Words whose properties a worker keeps at most.
KEPT = 300_000
#: Bytes of text that features are computed of together. Word lists and suffix arrays take
#: some fifty times that, and a worker keeps the memory that its largest step took.
TOGETHER = 1 << 19


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``doc_id, text, label`` of about ``rows`` labelled documents, by a hash of
    the id. The sampled ids are broadcast: ``rows`` bounds them."""
    known = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")
    ).where("doc_id is not null and label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    found = known.count()
    sampled = known.where(share(F.col("doc_id")) < min(1.0, rows / max(found, 1)))
    return docs.join(F.broadcast(sampled), "doc_id")


def labelled_features(
    docs: DataFrame, labels: DataFrame, label_col: str, of: Callable[[], Callable[[list], np.ndarray]], binary: bool
) -> DataFrame:
    """``doc_id, features, label`` of every labelled document. Features travel to the
    labels, texts stay where they are."""
    known = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")
    ).where("doc_id is not null and label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return featured(docs, of, binary).where("doc_id is not null").join(known, "doc_id")


_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>@^~_=+\\/{}[]`",
    "stop": b".?!",
    "loud": b"!",
    "asks": b"?",
    "comma": b",;:",
    "quote": b"\"'()-",
    "space": b" \t\r\v\f",
    "line": b"\n",
    "other": bytes(range(128, 192)),
    "lead": bytes(range(192, 256)),
}
_TABLE = np.array([[b in group for group in _CLASSES.values()] for b in range(256)], np.float64)
QUALITY_FEATURES = (
    *_CLASSES, "pipe", "log_words", "word_length", "distinct", "repeated", "longest", "dup_lines",
    "single_lines", "marked_words", "loud_words", "ends_clean",
)
_MARKED = re.compile(rb"[#*$%&|<>]{2,}(?:\s|$)")
_LOUD = re.compile(rb"[A-Z]{2,}[^\sa-z]*(?:\s|$)")


def quality_features(texts: list[bytes]) -> np.ndarray:
    """One row per text: shares of character classes, repetition, word shape."""
    texts = [t or b"" for t in texts]
    repeats = measure(texts)
    rows = np.zeros((len(texts), len(QUALITY_FEATURES)))
    for n, text in enumerate(texts):
        counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        words = text.split()
        size, total = max(len(text), 1), max(len(words), 1)
        lines = text.count(b"\n") + 1
        rows[n] = [
            *(counts @ _TABLE / size),
            counts[ord("|")] / total,
            math.log1p(len(words)) / 10,
            min(len(text) / total, 40) / 40,
            len(set(words)) / total,
            repeats["n_repeat_words"][n] / total,
            math.log1p(repeats["longest_repeat"][n]) / 10,
            duplicate_lines(text) / lines,
            lines / total,
            len(_MARKED.findall(text)) / total,
            len(_LOUD.findall(text)) / total,
            float(text.rstrip()[-1:] in (b".", b"!", b"?")),
        ]
    return rows


def featured(
    docs: DataFrame, of: Callable[[], Callable[[list], np.ndarray]], binary: bool, extra: str = ""
) -> DataFrame:
    """``doc_id, features array<double>`` and the integer column ``extra`` of
    ``(doc_id, text, extra)``; ``of()`` is called once a task."""
    names = ["doc_id", "features", *([extra] if extra else [])]
    types = ["doc_id long", "features array<double>", *([f"{extra} int"] if extra else [])]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = of()
        for batch in batches:
            done = 0
            for keys, texts in chunks([batch], TOGETHER):
                rows = function(texts)
                offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
                columns = [
                    pa.array(keys, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel())),
                ]
                if extra:
                    columns.append(batch.column(2).slice(done, len(keys)))
                done += len(keys)
                yield pa.RecordBatch.from_arrays(columns, names)

    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (text.cast("binary") if binary else text).alias("text"),
        *([extra] if extra else []),
    )
    return map_in_arrow(narrow, task, ", ".join(types))
