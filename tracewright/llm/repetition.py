"""Quality rules with suffix-array repetition (operator 3).

The words of a text form a sequence; its suffixes are sorted by prefix doubling,
many texts side by side, each with word numbers of its own. Where neighbours in
that order share ``min_words`` words or more, they lie in a longest-common-prefix
interval, which is a maximal repeated substring; a suffix's deepest interval is
given by the longer of its two neighbours' prefixes. The union of those spans and
the longest of them decide: a text is dropped if repeats cover more than
``max_covered`` of its word bytes or if one repeat is longer than ``max_longest``
words.

Defined results: null and empty texts have zero counts and fail the base rules, as
they have fewer than 20 words. Repeated rows repeat their result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tracewright.llm.common import chunks, id_and_text, record_batch
from tracewright.session import map_in_arrow

MIN_WORDS = 8
MAX_COVERED = 0.2
MAX_LONGEST = 100
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_SPACES = b" \t\n\v\f\r"


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``keys``, and in that order whether a new key starts."""
    order = np.argsort(keys, kind="stable")
    found = keys[order]
    return order, np.concatenate(([True], found[1:] != found[:-1]))


def suffix_array(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of numbered words, texts apart, and the ranks at each doubling.

    ``texts`` numbers the text of each word. Rank arrays say which suffixes agree
    on the first 1, 2, 4, … words; a suffix that ends earlier agrees with none.
    """
    count = len(words)
    order, new = _grouped(texts.astype(np.int64) * (int(words.max(initial=0)) + 1) + words)
    rank = np.empty(count + 1, np.int64)
    first = np.flatnonzero(new)
    rank[order] = first[np.cumsum(new) - 1]  # place of the first of its group
    rank[count] = -1
    last = np.concatenate((texts[1:] != texts[:-1], [True])) if count else np.empty(0, bool)
    ends = np.flatnonzero(last)
    end = np.repeat(ends + 1, np.diff(np.concatenate(([0], ends + 1)))) if count else ends
    levels = [rank[:count].copy()]
    step = 1
    open_ = _unresolved(order, new)
    while len(open_):
        # Within each group of equal rank, order by the rank `step` words on; what
        # has ended comes first, later starts (shorter rests) before earlier ones.
        ahead = open_ + step
        inside = ahead < end[open_]
        second = np.where(inside, rank[np.minimum(ahead, count)], -1 - open_)
        place = np.lexsort((second, rank[open_]))
        sorted_, base, second = open_[place], rank[open_][place], second[place]
        new_group = np.concatenate(([True], base[1:] != base[:-1]))
        new_pair = new_group | np.concatenate(([True], second[1:] != second[:-1]))
        at = np.arange(len(base))
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        pair_at = np.maximum.accumulate(np.where(new_pair, at, 0))
        rank[sorted_] = base + pair_at - group_at
        order[base + at - group_at] = sorted_
        levels.append(rank[:count].copy())
        step *= 2
        alone = new_pair & np.concatenate((new_pair[1:], [True]))
        open_ = sorted_[~alone]
    return order, levels


def _unresolved(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    alone = new & np.concatenate((new[1:], [True]))
    return order[~alone]


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """Common prefix in words of each suffix with the one before it in ``order``;
    0 where it is below ``least``."""
    shared = np.zeros(len(order) + 1, np.int64)
    top = int(least).bit_length() - 1
    if len(order) < 2 or top >= len(levels):
        return shared
    agree = np.flatnonzero(levels[top][order[1:]] == levels[top][order[:-1]])
    a, b = order[agree].copy(), order[agree + 1].copy()
    length = np.zeros(len(agree), np.int64)
    count = len(order)
    for level in range(len(levels) - 1, -1, -1):
        inside = (a < count) & (b < count)
        same = np.zeros(len(a), bool)
        same[inside] = levels[level][a[inside]] == levels[level][b[inside]]
        step = same.astype(np.int64) << level
        a, b, length = a + step, b + step, length + step
    shared[agree + 1] = np.where(length >= least, length, 0)
    return shared


def measure(texts: list[bytes], min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """Per text: words, covered words and bytes, longest repeat in words."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    number: dict[bytes, int] = {}
    flat = np.fromiter(
        (number.setdefault(w, len(number)) for w in chain.from_iterable(split)), np.int64, sizes.sum()
    )
    bytes_ = np.fromiter(map(len, chain.from_iterable(split)), np.int64, len(flat))
    texts_ = np.repeat(np.arange(len(texts)), sizes)
    covered = np.zeros(len(flat), bool)
    longest = np.zeros(len(texts), np.int64)
    if len(flat):
        order, levels = suffix_array(flat, texts_)
        shared = common_prefixes(order, levels, min_words)
        deepest = np.maximum(shared[:-1], shared[1:])
        marks = np.zeros(len(flat) + 1, np.int64)
        hit = deepest > 0
        np.add.at(marks, order[hit], 1)
        np.add.at(marks, order[hit] + deepest[hit], -1)
        covered = np.cumsum(marks[:-1]) > 0
        np.maximum.at(longest, texts_[order[hit]], deepest[hit])
    return {
        "n_words": sizes,
        "word_bytes": np.bincount(texts_, bytes_, len(texts)).astype(np.int64),
        "n_repeat_words": np.bincount(texts_, covered, len(texts)).astype(np.int64),
        "repeat_bytes": np.bincount(texts_, covered * bytes_, len(texts)).astype(np.int64),
        "longest_repeat": longest,
    }


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def code_points(text: bytes) -> int:
    """Code points that are no white space."""
    solid = text.translate(None, _SPACES)
    return len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("covered", pa.float64()),
        ("longest_repeat", pa.int64()),
    ]
)


def quality(
    docs: DataFrame,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per text: the base counts, ``base_failed``, ``kept``, the share of
    word bytes that repeats cover and the longest repeat in words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches):
            texts = [t or b"" for t in texts]
            found = measure(texts)
            words, repeated = found["n_words"], found["n_repeat_words"]
            share = found["repeat_bytes"] / np.maximum(found["word_bytes"], 1)
            failed = (words < 20) | (100 * repeated > 30 * words)
            good = (share <= max_covered) & (found["longest_repeat"] <= max_longest)
            yield record_batch(
                _SCHEMA,
                [
                    keys, words, [code_points(t) for t in texts],
                    [len(_SYMBOLS.findall(t)) for t in texts], [duplicate_lines(t) for t in texts],
                    repeated, failed, ~failed & good, share, found["longest_repeat"],
                ],
            )

    return map_in_arrow(
        id_and_text(docs, id_col, text_col, binary=True),
        task,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, covered double, longest_repeat long",
    )
