"""Benchmark decontamination by template canonicalisation (operator 9).

Words lose their punctuation and become tokens; numbers, units after them and
capitalised words become the placeholders of their type, everything else its lower
case. A template window is ``WINDOW`` consecutive tokens (the whole item if it is
shorter). Windows of documents and benchmark items with equal templates are joined
by hash, and the tokens behind the placeholders are compared along one alignment of a
document with an item. A name agrees where both sides show the same, or where the
document's name is the one that most occurrences of the item's name show, and the
item's name the one that most occurrences of the document's stand for; of equally
frequent ones none is. Numbers and measures agree with any other. A window counts if
all its names agree, so one altered name costs the windows that hold it and no others.
So a question whose numbers or names were exchanged is found, and a passage that only
has the same shape is not.

What a word is typed as depends on its case, so windows of ``WINDOW`` tokens are also
compared by their lower-case tokens alone, and a copy in other case is found. A window
with fewer than ``LITERALS`` plain tokens says too little by its template; it is
compared by its lower-case tokens only, so none is left out. Windows of shorter items
are compared by template or, with few literals, by tokens: their case matters.

A document is contaminated by an item if one of these holds:

- ``COVERED`` of the item's windows or more count;
- windows that count follow each other, in one alignment, over ``RUN`` tokens;
- windows that count hold ``WORDS`` of the item's tokens or more, wherever they stand,
  so that a few spread edits do not hide a copy.

Before the join, tasks drop document windows whose hash is in no benchmark window,
by a bit table of fixed size (``BITS``); however large the benchmark, that table does
not grow, it only lets more through to the join.

Defined results: null and empty documents and items match nothing. A verdict belongs to
a text: rows with a null id, or that share an id, are judged by their own texts, and one
that is contaminated is reported under its id, null or not. Repeated rows count once.
Items without an id match nothing. Ties cannot occur: every (document, item) above the
share is reported.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tracewright.llm.common import chunks, fresh, hold, id_and_text, record_batch
from tracewright.session import map_in_arrow

WINDOW = 8
LITERALS = 4
COVERED = 0.5
RUN = 13
WORDS = 0.75
BITS = 22
KEPT = 300_000
#: Units, by their usual short and long forms.
UNITS = frozenset(
    ("mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles",
     "mg", "g", "kg", "gram", "grams", "ton", "tons", "lb", "lbs", "pound", "pounds", "oz", "ml",
     "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "s", "sec", "second", "seconds",
     "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month",
     "months", "year", "years", "dollar", "dollars", "cent", "cents", "euro", "euros", "percent",
     "degree", "degrees", "mph", "kph", "kmh", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "j", "n")
)
_NUMBER = regex.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
_MEASURE = regex.compile(r"([+-]?[$€£]?\d[\d.,]*)(\p{L}+)$")
_EDGE = regex.compile(r"^[^\p{L}\p{N}$€£+-]+|[^\p{L}\p{N}%]+$")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xD6E8FEB86659FD93)


def token(word: str) -> tuple[str, str]:
    """The token of a word and what its template shows; empty for no token."""
    core = word.rstrip(".,;:!?")
    if core.isalpha():
        low = core.lower()
        return low, "<name>" if core[0].isupper() else low
    core = _EDGE.sub("", word)
    low = core.lower()
    if not core:
        return "", ""
    if _NUMBER.match(core):
        return low, "<number>"
    measure = _MEASURE.match(core)
    if measure and measure[2].lower() in UNITS:
        return low, "<measure>"
    if core[0].isupper():
        return low, "<name>"
    return low, low


class _Tokens(dict):
    """A number for each word, and by number: the hashes of its template and token,
    1 for a plain token, 1 for a unit. A word without a token has hash 0."""

    def __init__(self) -> None:
        super().__init__()
        self.grid = np.empty((0, 4), np.uint64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number

    def complete(self) -> None:
        rows = []
        for word in islice(self, len(self.grid), None):
            low, shown = token(word)
            raw = xxhash.xxh3_64_intdigest(low) if low else 0
            plain = shown == low
            rows.append((raw if plain else xxhash.xxh3_64_intdigest(shown), raw, plain, low in UNITS))
        if rows:
            self.grid = np.concatenate((self.grid, np.array(rows, np.uint64)))


_UNIT = np.uint64(xxhash.xxh3_64_intdigest("<unit>"))
_NUMBER_HASH = np.uint64(xxhash.xxh3_64_intdigest("<number>"))
_NAME_HASH = np.uint64(xxhash.xxh3_64_intdigest("<name>"))


class Canonical:
    """The tokens of some texts end to end, as arrays."""

    def __init__(self, texts: list[str | None], known: _Tokens) -> None:
        self.words = [text.split() if text else [] for text in texts]
        sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        flat = np.fromiter(
            map(known.__getitem__, chain.from_iterable(self.words)), np.int64, sizes.sum()
        )
        known.complete()
        grid = known.grid[flat]
        real = grid[:, 1] != 0
        #: Text, and place among its words, of each token.
        self.text = np.repeat(np.arange(len(texts)), sizes)[real]
        self.place = (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[real]
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.counts) - self.counts
        grid = grid[real]
        self.shown, self.raw = grid[:, 0].copy(), grid[:, 1].copy()
        unit = grid[:, 3] == 1
        unit[1:] &= (self.shown[:-1] == _NUMBER_HASH) & (self.text[1:] == self.text[:-1])
        unit[:1] = False
        self.shown[unit] = _UNIT
        self.literal = (grid[:, 2] == 1) & ~unit

    def windows(self, width: int, folded: bool) -> tuple[np.ndarray, np.ndarray]:
        """Where windows start, and their hashes: by template or, with few literals,
        by token. If ``folded``, windows with a template of their own have a hash by
        token as well, and so start twice."""
        count = len(self.text) - width + 1
        if count < 1 or width < 1:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        starts = np.flatnonzero(self.text[:count] == self.text[width - 1 :])
        shown = np.full(count, np.uint64(width))
        raw = np.full(count, np.uint64(width) + _LAST)
        for n in range(width):
            for mixed, column in ((shown, self.shown), (raw, self.raw)):
                mixed ^= column[n : n + count]
                mixed *= _STEP
                mixed ^= mixed >> np.uint64(29)
        total = np.concatenate(([0], np.cumsum(self.literal)))
        plain = (total[width:] - total[:-width])[starts]
        shown, raw = shown[starts] * _LAST, raw[starts] * _LAST
        if not folded:
            return starts, np.where(plain >= min(LITERALS, width), shown, raw)
        typed = (plain >= min(LITERALS, width)) & (plain < width)
        return np.concatenate((starts, starts[typed])), np.concatenate((raw, shown[typed]))

    def slots(self, at: int, width: int) -> tuple[list[str], list[bool], list[bool]]:
        """Tokens of a window, and which of them stand behind a placeholder, and behind
        that of a name."""
        span = slice(at, at + width)
        words = self.words[int(self.text[at])]
        tokens = [token(words[i])[0] for i in self.place[span].tolist()]
        return tokens, (~self.literal[span]).tolist(), (self.shown[span] == _NAME_HASH).tolist()


_WINDOW_TYPE = (
    "id {}, width int, hash long, place long, tokens array<string>, slots array<boolean>, "
    "names array<boolean>, n_windows long"
)
_WINDOWS = pa.schema(
    [
        ("width", pa.int32()),
        ("hash", pa.int64()),
        ("place", pa.int64()),
        ("tokens", pa.list_(pa.string())),
        ("slots", pa.list_(pa.bool_())),
        ("names", pa.list_(pa.bool_())),
        ("n_windows", pa.int64()),
    ]
)


def _windows(
    texts: DataFrame, widths: list[int] | None, window: int, table: np.ndarray | None, id_type: str = "long"
) -> DataFrame:
    """Windows of ``(id, text)``, the id a long or binary: of ``widths`` each, or for None of ``window``
    or the whole shorter text; only those whose bit is set in ``table``, if given."""

    kind = {"long": pa.int64(), "binary": pa.binary()}[id_type]
    schema = pa.schema([("id", kind), *_WINDOWS])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()
        for keys, rows in chunks(batches):
            if len(known) > KEPT:
                known = _Tokens()
            rows = [None if key is None else text for key, text in zip(keys, rows)]
            found = Canonical(rows, known)
            wanted = widths
            if widths is None:
                wanted = sorted(set(np.minimum(found.counts, window).tolist()) - {0})
            out: list[list] = [[] for _ in schema]
            for width in wanted:
                starts, hashes = found.windows(width, width == window)
                if widths is None:  # every text by its own width
                    own = np.minimum(found.counts, window)[found.text[starts]] == width
                    starts, hashes = starts[own], hashes[own]
                if table is not None:
                    on = _bit_set(table, hashes)
                    starts, hashes = starts[on], hashes[on]
                for at, value in zip(starts.tolist(), hashes.view(np.int64).tolist()):
                    text = int(found.text[at])
                    place = at - int(found.first[text])
                    number = int(found.counts[text]) - width + 1
                    row = (keys[text], width, value, place, *found.slots(at, width), number)
                    for column, cell in zip(out, row):
                        column.append(cell)
            yield record_batch(schema, out)

    return map_in_arrow(texts, task, _WINDOW_TYPE.format(id_type))


def _bit_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


def _bits(windows: DataFrame) -> np.ndarray:
    """``2**BITS`` bits, set where a window's hash points. At most 64 KiB rows come
    to the driver, whatever the number of windows."""
    spot = F.shiftrightunsigned("hash", 64 - BITS)
    cells = windows.groupBy(F.shiftright(spot, 6).alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 63 as int))")).alias("bits")
    )
    found = cells.toArrow()
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return table.view(np.uint8)


_AGREEING = pa.schema(
    [
        ("key", pa.binary()),
        ("item_id", pa.int64()),
        ("places", pa.list_(pa.int64())),
        ("identical", pa.list_(pa.int64())),
        ("run", pa.int64()),
        ("width", pa.int32()),
        ("n_windows", pa.int64()),
    ]
)


def agreeing(windows: list[dict]) -> tuple[list[int], list[int]]:
    """Of one alignment's windows, the item places of those whose names all agree, and
    of those that are the item's own words."""
    names = {(t["at"], t["b"], t["d"]) for w in windows for t in w["names"]}
    votes = Counter((b, d) for _, b, d in names)
    most: tuple[dict, dict] = ({}, {})
    for pair, count in votes.items():
        for side, of in zip(pair, most):
            best = of.get(side, (0, None))[0]
            if count >= best:
                of[side] = (count, pair if count > best else None)
    agreed = {p for p in votes if p[0] == p[1] or most[0][p[0]][1] == p == most[1][p[1]][1]}
    places = {w["place"] for w in windows if all((t["b"], t["d"]) in agreed for t in w["names"])}
    return sorted(places), sorted({w["place"] for w in windows if w["identical"]})


def longest_run(places: list[int]) -> int:
    """How many of the ascending ``places`` follow each other, at most."""
    longest = run = 0
    for n, place in enumerate(places):
        run = run + 1 if n and place == places[n - 1] + 1 else 1
        longest = max(longest, run)
    return longest


def _agreeing(aligned: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, items, windows, *sizes = (c.to_pylist() for c in batch.columns)
            places, identical = zip(*map(agreeing, windows)) if windows else ((), ())
            runs = list(map(longest_run, places))
            yield record_batch(_AGREEING, [docs, items, places, identical, runs, *sizes])

    return map_in_arrow(
        aligned.select("key", "item_id", "windows", "width", "n_windows"),
        task,
        "key binary, item_id long, places array<long>, identical array<long>, run long, width int, "
        "n_windows long",
    )


def _text_key(text: Column) -> Column:
    """A digest that stands for a text; null for a null one."""
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    covered: float = COVERED,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, n_matched, n_windows, changed``: documents that hold an
    item; ``changed`` if a matched window has only other slot values than the item's."""
    found = hold(_contaminated(docs[text_col], docs, benchmark, window, covered, item_col, item_text_col), "hits")
    ids = docs.select(docs[id_col].cast("long").alias("doc_id"), _text_key(docs[text_col]).alias("key"))
    return ids.join(found, "key").drop("key").distinct()


def _contaminated(
    text: Column, docs: DataFrame, benchmark: DataFrame, window: int, covered: float, item_col: str, item_text_col: str
) -> DataFrame:
    """``key, item_id, n_matched, n_windows, changed``, the key of a text."""
    items = hold(
        _windows(id_and_text(benchmark, item_col, item_text_col), None, window, None), "items"
    )
    widths = sorted(r.width for r in items.select("width").distinct().collect())
    table = _bits(items)
    texts = docs.select(_text_key(text).alias("key"), text.cast("string").alias("text"))
    near = _windows(texts, widths, window, table, "binary").select(
        F.col("id").alias("key"), "width", "hash", "place", F.col("tokens").alias("doc_tokens")
    )
    side = items.select(
        F.col("id").alias("item_id"), "width", "hash", F.col("place").alias("item_place"),
        "tokens", "slots", "names", "n_windows",
    )
    joined = near.join(side, ["width", "hash"])
    both = F.arrays_zip("tokens", "doc_tokens", "slots")
    # Equal hashes must be equal templates: plain tokens agree one by one.
    same = F.forall(both, lambda t: t.slots | (t.tokens == t.doc_tokens))
    named = F.transform(
        F.arrays_zip("tokens", "doc_tokens", "names"),
        lambda t, n: F.struct(
            (F.col("item_place") + n).alias("at"), t.tokens.alias("b"), t.doc_tokens.alias("d"), t.names.alias("n")
        ),
    )
    names = F.transform(
        F.filter(named, lambda t: t.n), lambda t: F.struct(t["at"].alias("at"), t.b.alias("b"), t.d.alias("d"))
    )
    window_at = F.struct(
        F.col("item_place").alias("place"),
        (F.col("tokens") == F.col("doc_tokens")).alias("identical"),
        names.alias("names"),
    )
    aligned = (
        joined.where(same)
        .groupBy("key", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(
            F.collect_set(window_at).alias("windows"),
            F.first("width").alias("width"),
            F.first("n_windows").alias("n_windows"),
        )
    )
    # The item's tokens in a window.
    held = lambda place: F.sequence(place, place + F.col("width") - 1)
    found = (
        _agreeing(aligned)
        .groupBy("key", "item_id")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.array_distinct(F.flatten(F.collect_list("identical"))).alias("identical"),
            F.max("run").alias("run"),
            F.first("width").alias("width"),
            F.first("n_windows").alias("n_windows"),
        )
        .select(
            "key",
            "item_id",
            F.size("places").cast("long").alias("n_matched"),
            "n_windows",
            (F.size("identical") < F.size("places")).alias("changed"),
            "run",
            "width",
            F.size(F.array_distinct(F.flatten(F.transform("places", held)))).alias("n_held"),
        )
    )
    tokens = F.col("n_windows") + F.col("width") - 1
    enough = (
        (F.col("n_matched") >= covered * F.col("n_windows"))
        | ((F.col("run") > 0) & (F.col("run") + F.col("width") - 1 >= RUN))
        | (F.col("n_held") >= WORDS * tokens)
    )
    return found.where((F.col("n_matched") > 0) & enough).drop("run", "width", "n_held")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark item contaminates."""
    key = fresh(docs.columns, "key")
    hits = _contaminated(docs[text_col], docs, benchmark, WINDOW, COVERED, "item_id", "text")
    hits = hold(hits.select(F.col("key").alias(key)).distinct(), "hits")
    return docs.join(hits, _text_key(docs[text_col]) == hits[key], "left_anti")
