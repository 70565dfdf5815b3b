"""SentencePiece encoding with seeded merge-dropout, and decoding (operator 1).

A text becomes one leading space plus itself, spaces written as U+2581, and is cut
where no piece of the vocabulary can reach across: before spaces that follow other
characters, and around characters that no longer piece contains. Each unit starts
as single characters. An agenda holds the candidate merges, best vocabulary score
first, then leftmost; a popped candidate is skipped when its keyed hash falls under
``dropout``, exactly where the usual encoder would merge. Characters outside the
vocabulary, and U+2581 itself, become byte pieces, so decoding gives back every byte.

The key of a candidate is (seed, stream, unit, left position, merged piece). Every
occurrence of a unit has a stream of its own, from the document's id and the unit's
position in it, so draws grow with the input; ``streams`` limits them to that many a
unit. With ``dropout=0`` the result is SentencePiece's own.

Defined results: null and empty texts give no pieces. Bytes that are no UTF-8
survive a round trip. Rows are independent; repeated rows repeat their result. Rows
with a null id draw as rows of one id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tracewright.llm.common import chunks, id_and_text
from tracewright.session import map_in_arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Longest unit that is segmented together with others; longer ones go singly.
TOGETHER = 128
#: Units of up to 32 characters in one pass of the joint agenda, and fewer longer ones;
#: small enough for a core's cache.
BLOCK = 12_000
_NONE = np.int32(1 << 30)
_MASK = (1 << 64) - 1
_FOLD, _LEFT, _PLACE, _LAST = (
    0x9E3779B97F4A7C15,
    0xD6E8FEB86659FD93,
    0xA0761D6478BD642F,
    0xE7037ED1A0B428DB,
)


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece BPE model."""

    def __init__(self, model: str = MODEL) -> None:
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_file=model)
        self.ids: dict[str, int] = {}
        self.order: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.bytes: list[bytes] = []
        scores = {}
        for number in range(processor.vocab_size()):
            piece = processor.id_to_piece(number)
            if processor.is_byte(number):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = number
                self.bytes.append(bytes([value]))
                continue
            special = (
                processor.is_control(number)
                or processor.is_unknown(number)
                or processor.is_unused(number)
            )
            self.bytes.append(b"" if special else piece.replace(SPACE, " ").encode())
            if not special:
                self.ids[piece] = number
                scores[piece] = processor.get_score(number)
        places = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.order = {p: places[s] for p, s in scores.items() if len(p) > 1}
        # Characters that occur in single-character pieces only.
        joined = {c for p in self.order for c in p}
        self.barriers = "".join(sorted(c for c in "\n\t\r" if c not in joined))

    def pairs(self) -> PairTable:
        return PairTable(self)

    def unit_pattern(self) -> re.Pattern:
        stop = re.escape(self.barriers)
        return re.compile(f"[{stop}]| +[^ {stop}]*|[^ {stop}]+" if stop else " +[^ ]*|[^ ]+")


class PairTable:
    """Which two adjacent pieces merge, as an open-addressed array for numpy."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids = vocabulary.ids
        rows = [
            (ids[piece[:cut]] << 20 | ids[piece[cut:]], place, ids[piece])
            for piece, place in vocabulary.order.items()
            for cut in range(1, len(piece))
            if piece[:cut] in ids and piece[cut:] in ids
        ]
        keys, places, merged = (np.array(c, np.int64) for c in zip(*rows))
        self.mask = (1 << (len(rows) * 4).bit_length()) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.places = np.full(self.mask + 1, _NONE, np.int32)
        self.merged = np.zeros(self.mask + 1, np.int32)
        self.probes = 0
        left = np.arange(len(keys))
        while len(left):
            slots = self._slot(keys[left], self.probes)
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[left[free]]  # of several for one slot the last stays
            stored = self.keys[slots] == keys[left]
            self.places[slots[stored]] = places[left[stored]]
            self.merged[slots[stored]] = merged[left[stored]]
            left = left[~stored]
            self.probes += 1
        #: Codepoint to the id of its own piece; -1 where there is none.
        self.single = np.full(0x110000, -1, np.int32)
        for piece, number in ids.items():
            if len(piece) == 1 and piece != SPACE:
                self.single[ord(piece)] = number
        self.single[ord(" ")] = ids.get(SPACE, -1)
        self.place_of = np.full(len(vocabulary.bytes), _NONE, np.int32)
        for piece, place in vocabulary.order.items():
            self.place_of[ids[piece]] = place

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        """The same as a dictionary, for one pair at a time."""
        used = np.flatnonzero(self.keys >= 0)
        columns = (self.keys, self.places, self.merged)
        return {k: (p, m) for k, p, m in zip(*(c[used].tolist() for c in columns))}

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(_FOLD)
        return ((mixed >> np.uint64(36)).astype(np.int64) + probe) & self.mask

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the order of merges (``_NONE``: no merge) and merged id."""
        keys = a.astype(np.int64) << 20 | b
        keys[(a < 0) | (b < 0)] = -2
        places = np.full(len(keys), _NONE, np.int32)
        merged = np.zeros(len(keys), np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            slots = self._slot(keys[open_], probe)
            held = self.keys[slots]
            hit = held == keys[open_]
            places[open_[hit]] = self.places[slots[hit]]
            merged[open_[hit]] = self.merged[slots[hit]]
            open_ = open_[~hit & (held != -1)]
            if not len(open_):
                break
        return places, merged


def _codes(unit: str) -> np.ndarray:
    return np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)


def _unit_keys(codes: np.ndarray, lengths: np.ndarray, seed: int, streams: np.ndarray) -> np.ndarray:
    """The key of each unit, a row of ``codes``, under (seed, stream)."""
    keys = np.uint64((seed * _LAST) & _MASK) ^ ((streams.astype(np.uint64) + 1) * np.uint64(_PLACE))
    for column in range(codes.shape[1]):
        mixed = (keys ^ codes[:, column]) * np.uint64(_FOLD)
        mixed ^= mixed >> np.uint64(29)
        keys = np.where(column < lengths, mixed, keys)
    return keys


def _dropped(keys: np.ndarray, left: np.ndarray, places: np.ndarray, limit: int) -> np.ndarray:
    """Whether the candidate at ``left`` with order ``places`` is skipped."""
    mixed = (
        keys
        ^ (left.astype(np.uint64) * np.uint64(_LEFT))
        ^ (places.astype(np.uint64) * np.uint64(_PLACE))
    )
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_LAST)
    return (mixed >> np.uint64(32)) < np.uint64(limit)


def _limit(dropout: float) -> int:
    return int(dropout * (1 << 32))


def _unit_key(codes: list[int], seed: int, stream: int) -> int:
    """:func:`_unit_keys` of one unit."""
    key = (seed * _LAST & _MASK) ^ ((stream + 1) * _PLACE & _MASK)
    for code in codes:
        key = (key ^ code) * _FOLD & _MASK
        key ^= key >> 29
    return key


def segment_one(
    unit: str, vocabulary: Vocabulary, table: PairTable, dropout: float, seed: int, stream: int
) -> tuple[list[int], int]:
    """Piece ids of one unit from an agenda kept as a heap, and the number of
    candidate merges skipped. Any length; ``segment_many`` agrees with it."""
    codes = _codes(unit)
    symbols = table.single[codes].tolist()
    count, limit, skipped = len(symbols), _limit(dropout), 0
    key = _unit_key(codes.tolist(), seed, stream) if limit else 0
    merges = table.merges
    left, right = list(range(-1, count - 1)), list(range(1, count + 1))
    # Pairs with a symbol of no piece (-1) have keys that no merge has.
    first_pairs = ((i, merges.get(a << 20 | b)) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
    agenda = [(m[0], i, i + 1, symbols[i], symbols[i + 1], m[1]) for i, m in first_pairs if m]
    heapify(agenda)
    while agenda:
        place, i, j, first, second, merged = heappop(agenda)
        if right[i] != j or symbols[i] != first or symbols[j] != second:
            continue  # a side was merged since
        if limit:
            mixed = key ^ (i * _LEFT & _MASK) ^ (place * _PLACE & _MASK)
            if ((mixed ^ mixed >> 29) * _LAST & _MASK) >> 32 < limit:
                skipped += 1
                continue
        before, after = left[i], right[j]
        symbols[i], right[i] = merged, after
        right[j] = -1
        if before >= 0 and (found := merges.get(symbols[before] << 20 | merged)):
            heappush(agenda, (found[0], before, i, symbols[before], merged, found[1]))
        if after < count:
            left[after] = i
            if found := merges.get(merged << 20 | symbols[after]):
                heappush(agenda, (found[0], i, after, merged, symbols[after], found[1]))
    out: list[int] = []
    at = 0
    while at < count:
        if symbols[at] >= 0:
            out.append(symbols[at])
        else:
            raw = unit[at].encode("utf-8", "surrogateescape")
            out.extend(vocabulary.byte_ids[b] for b in raw)
        at = right[at]
    return out, skipped


def segment_many(
    units: list[str],
    streams: np.ndarray,
    vocabulary: Vocabulary,
    table: PairTable,
    dropout: float,
    seed: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of many units: offsets, ids end to end, skipped candidates.

    The agendas of all units of similar length advance together: each step takes
    the best candidate of every unit, skips or merges it, and looks up the one or
    two candidates that this makes.
    """
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    sizes = np.zeros(len(units), np.int64)
    skipped = np.zeros(len(units), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    low = 0
    for high in (4, 7, 10, 14, 20, 32, 64, TOGETHER):
        together = np.flatnonzero((lengths > low) & (lengths <= high))
        low = high
        block = BLOCK * 32 // max(high, 32)
        for start in range(0, len(together), block):
            rows = together[start : start + block]
            found = _segment_rows(
                [units[r] for r in rows.tolist()], lengths[rows], high, streams[rows], vocabulary,
                table, dropout, seed,
            )
            sizes[rows], skipped[rows] = found[0], found[2]
            parts.append((rows, found[1]))
    for row in np.flatnonzero(lengths > TOGETHER).tolist():
        ids, lost = segment_one(units[row], vocabulary, table, dropout, seed, int(streams[row]))
        sizes[row], skipped[row] = len(ids), lost
        parts.append((np.array([row]), np.array(ids, np.int32)))
    offsets = np.zeros(len(units) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    values = np.empty(offsets[-1], np.int32)
    for rows, ids in parts:
        values[spans(offsets[rows], sizes[rows])] = ids
    return offsets, values, skipped


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0]+1, …`` for each start and size, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _segment_rows(
    units: list[str],
    lengths: np.ndarray,
    width: int,
    streams: np.ndarray,
    vocabulary: Vocabulary,
    table: PairTable,
    dropout: float,
    seed: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = _codes("".join(units))
    inside = np.arange(width) < lengths[:, None]
    codes = np.zeros((len(units), width), np.uint32)
    codes[inside] = flat
    limit = _limit(dropout)
    keys = _unit_keys(codes, lengths, seed, streams)
    # One cell per character; -2 where nothing starts (any more).
    symbols = np.where(inside, table.single[codes], -2).astype(np.int32)
    places = np.full(symbols.shape, _NONE, np.int32)
    merged = np.zeros(symbols.shape, np.int32)
    both = np.flatnonzero(inside[:, 1:].ravel())
    both += both // (width - 1) if width > 1 else 0
    flat_symbols, flat_places, flat_merged = symbols.ravel(), places.ravel(), merged.ravel()
    flat_places[both], flat_merged[both] = table.find(flat_symbols[both], flat_symbols[both + 1])
    index = np.arange(width, dtype=np.int32)
    after = np.broadcast_to(index + 1, symbols.shape).copy().ravel()
    before = np.broadcast_to(index - 1, symbols.shape).copy().ravel()
    skipped = np.zeros(len(units), np.int64)
    alive = np.arange(len(units))
    while True:
        best = places[alive].argmin(1)
        cells = alive * width + best
        place = flat_places[cells]
        going = place < _NONE
        if not going.all():
            alive, best, cells, place = alive[going], best[going], cells[going], place[going]
            if not len(alive):
                break
        rows = alive
        if limit:
            lost = _dropped(keys[rows], best, place, limit)
            skipped[rows[lost]] += 1
            flat_places[cells[lost]] = _NONE
            kept = ~lost
            rows, best, cells = rows[kept], best[kept], cells[kept]
        base = cells - best
        joined = flat_merged[cells]
        gone = after[cells]
        right = after[base + gone]
        flat_symbols[cells] = joined
        flat_symbols[base + gone] = -2
        flat_places[base + gone] = _NONE
        flat_places[cells] = _NONE
        after[cells] = right
        on = np.flatnonzero(right < lengths[rows])
        where = cells[on]
        far = base[on] + right[on]
        before[far] = best[on]
        flat_places[where], flat_merged[where] = table.find(joined[on], flat_symbols[far])
        left = before[cells]
        on = np.flatnonzero(left >= 0)
        where = base[on] + left[on]
        flat_places[where], flat_merged[where] = table.find(flat_symbols[where], joined[on])
    sizes = (symbols != -2).sum(1)
    ids = symbols[symbols != -2]
    if (ids < 0).any():
        ids, sizes = _with_bytes(units, symbols, vocabulary)
    return sizes, ids, skipped


def _with_bytes(
    units: list[str], symbols: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes, characters without a piece replaced by their byte pieces."""
    row, place = np.nonzero(symbols != -2)
    flat = symbols[row, place]
    sizes = np.ones(len(flat), np.int64)
    raws = {}
    for n in np.flatnonzero(flat < 0).tolist():
        raw = units[row[n]][place[n]].encode("utf-8", "surrogateescape")
        raws[n] = [vocabulary.byte_ids[b] for b in raw]
        sizes[n] = len(raw)
    ids = np.repeat(flat, sizes)
    at = np.cumsum(sizes) - sizes
    for n, values in raws.items():
        ids[at[n] : at[n] + len(values)] = values
    return ids, np.bincount(row, sizes, len(units)).astype(np.int64)


class _Numbers(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        return number


class Encoder:
    """Encodes texts together: with dropout every occurrence of a unit by its own
    draws, or by those of one of ``streams`` streams; without, each distinct unit once."""

    def __init__(
        self, vocabulary: Vocabulary, dropout: float, seed: int, streams: int | None = None
    ) -> None:
        self.vocabulary, self.dropout, self.seed, self.streams = vocabulary, dropout, seed, streams
        self.pattern = vocabulary.unit_pattern()
        self.table = vocabulary.pairs()

    def encode(
        self, raws: list[bytes | None], keys: list[int | None]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets per text, ids end to end, skipped candidates per text."""
        units: list[str] = []
        bounds, streams = [0], [np.empty(0, np.uint64)]
        for raw, key in zip(raws, keys):
            if raw:
                units += self.pattern.findall(" " + raw.decode("utf-8", "surrogateescape"))
                first = xxhash.xxh3_64_intdigest(str(key).encode(), seed=self.seed & _MASK)
                streams.append(self._streams(first, len(units) - bounds[-1]))
            bounds.append(len(units))
        if self.dropout > 0:
            offsets, ids, skipped = self._segment(units, np.concatenate(streams))
        else:
            offsets, ids, skipped = self._plain(units)
        lost = np.diff(np.concatenate(([0], np.cumsum(skipped)))[bounds])
        return offsets[bounds], ids, lost

    def _streams(self, first: int, count: int) -> np.ndarray:
        places = np.arange(count, dtype=np.uint64)
        if self.streams is None:
            return places + np.uint64(first)
        return (places + np.uint64(first % self.streams)) % np.uint64(self.streams)

    def _segment(self, units: list[str], streams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return segment_many(units, streams, self.vocabulary, self.table, self.dropout, self.seed)

    def _plain(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = _Numbers()
        flat = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        offsets, ids, skipped = self._segment(list(known), np.zeros(len(known), np.uint64))
        sizes = np.diff(offsets)[flat]
        return np.concatenate(([0], np.cumsum(sizes))), ids[spans(offsets[flat], sizes)], skipped[flat]


def decoded(ids: np.ndarray, pieces: Pieces) -> bytes:
    """The bytes that ``ids`` stand for, without the leading space of encoding."""
    return pieces.join(ids)[1:]


class Pieces:
    """The bytes of every piece, end to end."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.bytes = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)
        self.sizes = np.fromiter(map(len, vocabulary.bytes), np.int64, len(vocabulary.bytes))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, ids: np.ndarray) -> bytes:
        return self.bytes[spans(self.starts[ids], self.sizes[ids])].tobytes()


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _encoded(docs: DataFrame, make: Callable, schema: str, id_col: str, text_col: str, **how) -> DataFrame:
    vocabulary = Vocabulary(how["model"])
    dropout, seed, streams = how["dropout"], how["seed"], how["streams"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, dropout, seed, streams)
        pieces = Pieces(vocabulary)
        for keys, raws in chunks(batches):
            offsets, ids, lost = encoder.encode(raws, keys)
            yield make(pieces, keys, raws, offsets, ids, lost)

    return map_in_arrow(id_and_text(docs, id_col, text_col, binary=True), task, schema)


def _pieces_only(pieces, keys, raws, offsets, ids, lost) -> pa.RecordBatch:
    columns = [pa.array(keys, pa.int64()), _lists(offsets, ids), pa.array(lost)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_skipped"])


def _pieces_checked(pieces, keys, raws, offsets, ids, lost) -> pa.RecordBatch:
    same = [
        decoded(ids[offsets[n] : offsets[n + 1]], pieces) == (raw or b"") for n, raw in enumerate(raws)
    ]
    columns = [
        pa.array(keys, pa.int64()),
        _lists(offsets, ids),
        pa.array(np.diff(offsets)),
        pa.array(lost),
        pa.array(same),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_ids", "n_skipped", "lossless"])


def encode(
    docs: DataFrame,
    model: str = MODEL,
    dropout: float = 0.1,
    seed: int = 17,
    streams: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, ids array<int>, n_skipped long``: the pieces of every text."""
    return _encoded(
        docs, _pieces_only, "doc_id long, ids array<int>, n_skipped long", id_col, text_col,
        model=model, dropout=dropout, seed=seed, streams=streams,
    )


def encode_checked(
    docs: DataFrame,
    model: str = MODEL,
    dropout: float = 0.1,
    seed: int = 17,
    streams: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """:func:`encode`, with each text decoded again in the same task: also
    ``n_ids long`` and ``lossless boolean`` (the decoded bytes are the text's)."""
    return _encoded(
        docs, _pieces_checked,
        "doc_id long, ids array<int>, n_ids long, n_skipped long, lossless boolean", id_col, text_col,
        model=model, dropout=dropout, seed=seed, streams=streams,
    )


def decode(
    encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``doc_id, text``: what the pieces in ``ids_col`` stand for. Null ids: empty."""
    vocabulary = Vocabulary(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocabulary)
        for batch in batches:
            raws = [
                decoded(np.array(ids.as_py(), np.int64), pieces) if ids.is_valid else b""
                for ids in batch.column(1)
            ]
            columns = [batch.column(0), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "raw"])

    found = map_in_arrow(
        encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].alias("ids")),
        task,
        "doc_id long, raw binary",
    )
    return found.select("doc_id", found.raw.cast("string").alias("text"))
