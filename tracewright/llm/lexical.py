"""Ranked lexical search with bag deduplication (operator 13).

For each item, the ``k`` documents that score highest. Documents are restricted to the
items' vocabulary: what is left of one is its *bag*, the (term, occurrences) pairs it
shares with any item, and its length norm ``m``. Documents with equal bag and norm score
equally for every item, so each such class is scored once.

- *Bags.* One scan cuts all texts into terms and keeps ``n`` (all terms) and the bag.
  Texts do not travel.
- *Classes* are grouped by a hash of (m, bag) and by both themselves, which verifies the
  hash. Copies combine before the shuffle.
- *Scoring.* Tasks add up weights along the items' posting lists and hold ``k`` classes
  an item. A class that ``k`` others precede, by score and smallest doc_id, has no
  document among the best ``k``, so this loses none, whatever the ties.
- *Members.* Only the classes that won are expanded, by ascending doc_id, ``k`` documents
  each at most, which is cut before the shuffle.

Items travel with the tasks in blocks of at most ``ITEM_TERMS`` terms (summed over the
items) and ``ITEMS`` items; more items take more blocks, each a pass over the documents.

Defined results: null and empty texts have no terms and are never ranked; items without
terms, or whose terms no document holds, return no rows. Every row is a document of its
own, repeated rows too, so an id may stand twice in a ranking; a null id ranks last among
equal scores. Equal items count once; an item_id with two texts ranks for each. Extra
columns of either input are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tracewright.llm.common import chunks, hold, id_and_text, record_batch
from tracewright.session import map_in_arrow

#: Documents returned for an item.
K = 10
#: Bounds of a block of items: terms summed over its items, and items.
ITEM_TERMS = 1 << 18
ITEMS = 1 << 12
#: Length norm: ``m = FLAT + (SLOPED * n * N) div L``.
FLAT, SLOPED = 10, 90
#: Cells of scores, and steps along posting lists, that a task handles at once.
_CELLS = 1 << 19
_STEPS = 1 << 21

#: Bytes of terms: digits, ASCII letters and all of UTF-8 beyond ASCII. The others end a term.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM).split() if text else []


class Block:
    """Some items, their terms numbered, and the items of each term."""

    def __init__(self, items: list[tuple[int | None, set[bytes]]]):
        self.item_ids = [item for item, _ in items]
        self.numbers: dict[bytes, int] = {}
        pairs = [(self.numbers.setdefault(t, len(self.numbers)), n) for n, (_, ts) in enumerate(items) for t in sorted(ts)]
        pairs.sort()
        self.holders = np.array([n for _, n in pairs], np.int64)
        self.lengths = np.bincount([t for t, _ in pairs], minlength=len(self.numbers))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))


def blocks(items: DataFrame, most_terms: int = ITEM_TERMS, most_items: int = ITEMS) -> Iterator[Block]:
    """Distinct ``(doc_id, text)`` items that have terms, a bounded number at a time."""
    found: list[tuple[int | None, set[bytes]]] = []
    size = 0
    for row in items.distinct().toLocalIterator():
        own = set(terms(bytes(row["text"]) if row["text"] is not None else None))
        if found and (size + len(own) > most_terms or len(found) >= most_items):
            yield Block(found)
            found, size = [], 0
        if own:
            found.append((row["doc_id"], own))
            size += len(own)
    if found:
        yield Block(found)


_BAGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("bag", pa.binary())])


def bags(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag`` of the documents with terms; a bag is pairs of 32-bit numbers
    (term, occurrences), terms ascending."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks(batches):
            keys, sizes, packed = [], [], []
            for key, text in zip(ids, texts):
                if found := terms(text):
                    counts = Counter(found)
                    held = sorted((numbers[t], counts[t]) for t in counts.keys() & numbers.keys())
                    keys.append(key)
                    sizes.append(len(found))
                    packed.append(np.array(held, "<u4").tobytes())
            if keys:
                yield record_batch(_BAGS, [keys, sizes, packed])

    return map_in_arrow(docs, task, "doc_id long, n long, bag binary")


_HELD = pa.schema([("term", pa.int64()), ("df", pa.int64())])


def holding(found: DataFrame, count: int) -> np.ndarray:
    """Documents that hold each of the ``count`` terms."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").reshape(-1, 2)
            total += np.bincount(pairs[:, 0], minlength=count)
        held = np.flatnonzero(total)
        yield record_batch(_HELD, [held, total[held]])

    counted = map_in_arrow(found.select("bag"), task, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(count, np.int64)
    for row in counted.collect():
        df[row["term"]] = row["df"]
    return df


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)


class Best:
    """The ``k`` best classes of each item so far: score, smallest doc_id, class."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows = np.empty((4, 0), np.int64)
        self.floor = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, first: np.ndarray, number: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.floor)
        if len(row):
            new = np.stack([item, scores[row, item], first[row], number[row]])
            rows = np.concatenate([self.rows, new], axis=1)
            rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
            begins = np.flatnonzero(np.diff(rows[0], prepend=-1))
            place = np.arange(rows.shape[1]) - np.repeat(begins, np.diff(begins, append=rows.shape[1]))
            self.rows = rows[:, place < self.k]
            last = rows[:, place == self.k - 1]
            self.floor[last[0]] = last[1]


_BEST = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("first", pa.int64()), ("class", pa.int64())])


def best_classes(classes: DataFrame, block: Block, weight: np.ndarray, k: int) -> DataFrame:
    """``item, score, first, class``: each task's ``k`` best of ``class, first, m, bag``."""
    holders, lengths, starts, items = block.holders, block.lengths, block.starts, len(block.item_ids)

    def scores(rows: int, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        total = np.zeros((rows, items), np.int64)
        steps = lengths[term]
        cuts = np.searchsorted(np.cumsum(steps), np.arange(_STEPS, steps.sum() + _STEPS, _STEPS))
        begin = 0
        for end in [*(cuts + 1), len(term)]:
            part = slice(begin, min(end, len(term)))
            begin = part.stop
            size = steps[part]
            if size.sum():
                offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                cell = np.repeat(row[part], size) * items + holders[np.repeat(starts[term[part]], size) + offset]
                worth = np.repeat(value[part], size)
                # Sums of halves are exact as doubles.
                for half, scale in ((worth >> 24, 1 << 24), (worth & 0xFFFFFF, 1)):
                    counted = np.bincount(cell, half, rows * items).astype(np.int64)
                    total += counted.reshape(rows, items) * scale
        return total

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(items, k)
        step = max(1, min(1024, _CELLS // items))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                number, norm = (np.array(part.column(n), np.int64) for n in (0, 2))
                # A class of null ids only comes after all others.
                first = np.array(part.column(1).fill_null(np.iinfo(np.int64).max), np.int64)
                packed = part.column(3).to_pylist()
                pairs = np.frombuffer(b"".join(packed), "<u4").reshape(-1, 2).astype(np.int64)
                row = np.repeat(np.arange(len(packed)), [len(p) // 8 for p in packed])
                term, tf = pairs[:, 0], pairs[:, 1]
                value = weight[term] * ((10**9 * tf) // (1000 * tf + 8 * norm[row]))
                best.add(scores(len(packed), row, term, value), first, number)
        item, score, first, number = best.rows
        yield record_batch(_BEST, [item, score, first, number])

    return map_in_arrow(
        classes.select("class", "first", "m", "bag"), task, "item long, score long, first long, class long"
    )


def _first_rows(rows: DataFrame, k: int, key: str, *order) -> DataFrame:
    """``rows`` and ``rank`` of the ``k`` first of each key, cut before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(
        F.col("rank") <= k
    )


def _ranked(docs: DataFrame, block: Block, k: int) -> DataFrame:
    found = hold(bags(docs, block.numbers), "bags")
    documents, length = found.agg(F.count("*"), F.sum("n")).first()
    weight = weights(documents, holding(found, len(block.numbers)))
    norm = F.lit(FLAT) + F.expr(f"({SLOPED} * n * {documents}L) div {length or 1}L")
    held = found.where(F.octet_length("bag") > 0).select("doc_id", norm.cast("long").alias("m"), "bag")
    classes = hold(
        held.groupBy(F.xxhash64("m", "bag").alias("hash"), "m", "bag")
        .agg(F.min("doc_id").alias("first"))
        .withColumn("class", F.monotonically_increasing_id()),
        "bag_classes",
    )
    won = hold(
        _first_rows(
            best_classes(classes, block, weight, k), k, "item", F.desc("score"), F.col("first"), F.col("class")
        ).select("item", "score", "class"),
        "best_classes",
    )
    winners = classes.join(won.select("class").distinct(), "class").select("class", "hash", "m", "bag")
    members = held.withColumn("hash", F.xxhash64("m", "bag")).join(winners, ["hash", "m", "bag"])
    ids = _first_rows(members.select("class", "doc_id"), k, "class", F.asc_nulls_last("doc_id")).drop("rank")
    ranked = _first_rows(won.join(ids, "class"), k, "item", F.desc("score"), F.asc_nulls_last("doc_id"))
    names = docs.sparkSession.createDataFrame(list(enumerate(block.item_ids)), "item long, item_id long")
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    item_terms: int = ITEM_TERMS,
) -> DataFrame:
    """``item_id long, rank int, doc_id long, score long``: each item's ``k`` best."""
    narrow = id_and_text(docs, id_col, text_col, binary=True)
    asked = id_and_text(items, item_col, item_text_col, binary=True)
    result = None
    for block in blocks(asked, item_terms):
        ranked = _ranked(narrow, block, k)
        result = ranked if result is None else result.unionByName(ranked)
    if result is None:
        result = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result


def oracle() -> str:
    """The same ranking by joining every term, for tables with distinct ids."""
    cut = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({lower.format("text")}, '{cut}') AS terms FROM documents),
total AS (
  SELECT count(*) FILTER (len(terms) > 0) AS documents, sum(len(terms))::BIGINT AS length FROM doc),
held AS (
  SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM doc),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weighted AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, total),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({lower.format("text")}, '{cut}')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * ({FLAT} + ({SLOPED} * n * documents) // length))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weighted USING (term), total GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
    doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
