"""Suffix-array dedup of byte strings across all documents (operator 2).

Every byte covered by a ``LEAST``-byte string that starts earlier too (in a document
with a smaller id, or earlier in the same document) is removed. Strings are compared
on the whole input and never cross documents.

*Dealing out.* A string's anchor is the smallest of the hashes of the ``GRAM``-byte
grams in it, the leftmost of equals, so equal strings have equal anchors. The strings
of a text that share an anchor start in one run; the bytes they span are its
context. Contexts are dealt out by anchor, so all occurrences of a string meet. First
the anchors alone are counted; anchors that occur once go no further, by a bit table
that grows with the number of the others up to a limit (``MOST_BITS``). It lets some
through needlessly and none get lost. Equal
contexts are one class, combined before the shuffle; all its occurrences but the first
are repeats as a whole. Anchors with many occurrences are split over several tasks by a
hash of the context.

*Comparing.* Contexts that differ from all others of their anchor so near to it that
they share no string with one are done. The rest of a block of anchors are joined to one text, whose
Burrows-Wheeler transform is built from suffixes sorted as deep as ``LEAST``. Common
prefixes then come by increasing value: a pair of neighbours that start with the same
byte is the backward extension of the interval between the two suffixes behind that
byte, so it has common prefix l + 1 once that interval holds one of l. All intervals
of one level are extended together, breadth first, until the level reaches ``LEAST``:
an interval of one place from that place, the wider ones by a count of the places passed;
what has no value then shares ``LEAST`` bytes or more. The first of each such group of
strings stays. For split anchors, strings that are first in their part meet once more
by a 128-bit digest.

Defined results: a null text is empty. A null id comes before all others. Rows that
repeat an id and its text are the same document: neither repeats the other. Different
texts under one id, or without an id, are documents of their own, in the order of a
64-bit hash of the text (``copy``). Texts shorter than ``LEAST`` stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tracewright.llm.common import chunks, hold, id_and_text, record_batch
from tracewright.session import map_in_arrow

LEAST = 100
GRAM = 16
#: The table of repeated anchors has 2**BITS bits, or ROOM and more for each of them up to
#: 2**MOST_BITS (64 MB), beyond which more contexts travel.
BITS, MOST_BITS, ROOM = 26, 29, 32
#: Occurrences of an anchor that one part takes, about.
PART = 4_000
#: Bytes of contexts compared together.
BLOCK_BYTES = 30_000
#: Texts longer than this are read in overlapping stretches.
STRETCH = 1 << 20
#: Bytes of short texts whose anchors are looked for together.
JOINED = 1 << 16
#: Classes of strings by where their anchor lies, for :func:`_may_repeat`.
SIDES = 4
_NO_ID = -(1 << 63)
#: Texts whose removed bytes are worked out together.
_ROWS = 64
_A, _B, _C = (
    np.uint64(0x9E3779B97F4A7C15),
    np.uint64(0xC2B2AE3D27D4EB4F),
    np.uint64(0xD6E8FEB86659FD93),
)
_LOW = np.uint64(0xFFFFFFFF)


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each position."""
    words = np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1)).copy()
    words = words.view(np.uint64).ravel()
    count = len(text) - GRAM + 1
    mixed = (words[:count] * _A) ^ (words[8 : 8 + count] * _B)
    mixed ^= mixed >> np.uint64(32)
    mixed *= _C
    return mixed ^ (mixed >> np.uint64(29))


def _joined_runs(pieces: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """Piece, anchor hash, place of the anchor, first and last start of each run of
    strings that share an anchor; the pieces lie behind each other, and places count
    from the first one's start."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    hashes = _gram_hashes(text)
    width = least - GRAM + 1
    count = len(hashes)
    # Hash above, place below: the minimum is the leftmost smallest.
    low = (hashes & ~_LOW) | np.arange(count, dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    starts = count - width + 1
    place = (np.minimum(low[:starts], low[width - span : width - span + starts]) & _LOW).astype(np.int64)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    new = np.concatenate(([True], place[1:] != place[:-1]))
    new[(ends - sizes)[1:]] = True
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [starts])) - 1
    # No string lies in two pieces.
    piece = np.searchsorted(ends, first, "right")
    final = ends[piece] - least
    piece, first, last, final = (c[first <= final] for c in (piece, first, last, final))
    place = place[first]
    # Smallest hashes are small: spread them over all bits again.
    values = hashes[place] * _B
    values ^= values >> np.uint64(32)
    return piece, values * _A, place, first, np.minimum(last, final)


def runs(raws: list[bytes | None], least: int) -> tuple[np.ndarray, ...]:
    """Of all texts the runs of strings of ``least`` bytes that share an anchor: the
    text's number, the anchor's hash and place, first and last start.

    Runs end at fixed multiples of ``STRETCH`` as well, which parts a context but
    loses no string. Short texts are worked on together, ``JOINED`` bytes or more.
    """
    empty = np.empty(0, np.int64)
    found = [(empty, empty.astype(np.uint64), empty, empty, empty)]
    pieces: list[tuple[int, int, bytes]] = []
    size = 0

    def work() -> None:
        piece, values, *places = _joined_runs([p[2] for p in pieces], least)
        lengths = np.array([len(p[2]) for p in pieces])
        # From places among the pieces to places in their texts.
        shift = (np.array([p[1] for p in pieces]) - np.cumsum(lengths) + lengths)[piece]
        found.append((np.array([p[0] for p in pieces])[piece], values, *[c + shift for c in places]))

    for n, raw in enumerate(raws):
        for begin in range(0, len(raw or b"") - least + 1, STRETCH):
            pieces.append((n, begin, raw[begin : begin + STRETCH + least - 1]))
            size += len(pieces[-1][2])
            if size >= JOINED:
                work()
                pieces, size = [], 0
    if pieces:
        work()
    return tuple(np.concatenate(c) for c in zip(*found))


def anchors(raw: bytes, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last start of the strings of one text that share it."""
    _, values, _, first, last = runs([raw], least)
    return values, first, last


def _marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() + 2
    spot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


_PAGE_BITS = 13


def _bit_table(counted: DataFrame) -> np.ndarray:
    """A table with a bit set for each ``anchor``. Tasks make its pages, so what reaches
    the driver is the table."""
    bits = min(max(BITS, (ROOM * counted.count() - 1).bit_length()), MOST_BITS)
    page_bits = min(_PAGE_BITS, bits)
    schema = pa.schema([("page", pa.int64()), ("bits", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}  # packed
        for batch in batches:
            spots = np.unique(batch.column("spot").to_numpy())
            edges = np.flatnonzero(np.diff(spots >> page_bits)) + 1
            for own in np.split(spots, edges) if len(spots) else ():
                page = np.zeros(1 << page_bits, bool)
                page[own & (1 << page_bits) - 1] = True
                packed, number = np.packbits(page, bitorder="little"), int(own[0]) >> page_bits
                pages[number] = pages[number] | packed if number in pages else packed
        yield record_batch(schema, [list(pages), [page.tobytes() for page in pages.values()]])

    spot = F.shiftrightunsigned("anchor", 64 - bits).alias("spot")
    spots = counted.select(spot).repartition(F.shiftright("spot", page_bits))
    found = map_in_arrow(spots, task, "page long, bits binary").toArrow()
    table = np.zeros((1 << (bits - page_bits), 1 << (page_bits - 3)), np.uint8)
    for page, packed in zip(found["page"].to_pylist(), found["bits"]):
        table[page] = np.frombuffer(packed.as_buffer(), np.uint8)
    return table.ravel()


def _anchor_rows(texts: DataFrame, least: int) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("uses", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raws in chunks(batches):
            values, uses = np.unique(runs(raws, least)[1], return_counts=True)
            yield record_batch(schema, [values.view(np.int64), uses])

    return map_in_arrow(texts, task, "anchor long, uses long")


_CONTEXTS = pa.schema(
    [
        ("anchor", pa.int64()),
        ("context", pa.int64()),
        ("doc", pa.int64()),
        ("copy", pa.int64()),
        ("low", pa.int64()),
        ("at", pa.int32()),
        ("bytes", pa.binary()),
    ]
)


def copy_of(raw: bytes) -> int:
    """The hash that tells texts under one id apart, as ``F.xxhash64`` has it."""
    value = xxhash.xxh64_intdigest(raw, 42)
    return value - (1 << 64) if value >> 63 else value


def _context_rows(texts: DataFrame, table: np.ndarray, least: int) -> DataFrame:
    """The first occurrence of each distinct context in a chunk of texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, raws in chunks(batches):
            found: dict[tuple[int, int], tuple[int, int, int, int, bytes]] = {}
            owners = [
                (_NO_ID if key is None else key, copy_of(raw)) if raw is not None else None
                for key, raw in zip(keys, raws)
            ]
            number, values, place, low, high = runs(raws, least)
            on = _marked(table, values)
            columns = number[on], values[on].view(np.int64), place[on], low[on], high[on] + least
            for n, anchor, at, begin, end in zip(*(c.tolist() for c in columns)):
                bytes_ = raws[n][begin:end]
                name = anchor, xxhash.xxh3_64_intdigest(bytes_)
                before = found.get(name)
                if before is None or (*owners[n], begin) < before[:3]:
                    found[name] = *owners[n], begin, at - begin, bytes_
            rows = list(found.values())
            context = np.array([name[1] for name in found], np.uint64).view(np.int64)
            columns = [[row[i] for row in rows] for i in range(5)]
            yield record_batch(_CONTEXTS, [[name[0] for name in found], context, *columns])

    return map_in_arrow(
        texts, task, "anchor long, context long, doc long, copy long, low long, at int, bytes binary"
    )


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, right to ``depth`` symbols at least (in any order beyond), and
    the Burrows-Wheeler transform that belongs to it. A sort joins as many ranks as
    64 bits hold: four of a block's usual size, so three sorts reach 112 symbols."""
    count = len(symbols)
    padded = np.concatenate((symbols, np.zeros(7, symbols.dtype))).astype(np.uint64)
    keys = padded[:count].copy()
    for n in range(1, 7):
        keys <<= np.uint64(9)
        keys |= padded[n : n + count]
    known, bits = 7, count.bit_length()
    order = np.argsort(keys)
    while True:
        found = keys[order]
        new = np.concatenate(([True], found[1:] != found[:-1]))
        if known >= depth or new.all():
            break
        joined = min(64 // bits, -(-depth // known))
        rank = np.zeros(count + known * (joined - 1), np.uint64)
        rank[order] = np.cumsum(new, dtype=np.uint64)
        keys = rank[:count].copy()
        for n in range(1, joined):
            keys <<= np.uint64(bits)
            keys |= rank[n * known : n * known + count]
        order = np.argsort(keys)
        known *= joined
    return order, symbols[order - 1]


def common_prefix_values(bwt: np.ndarray, least: int) -> np.ndarray:
    """Per suffix in order, its common prefix with the one before; ``least`` stands
    for that many or more."""
    count = len(bwt)
    behind = np.argsort(bwt, kind="stable")  # where the suffix after the first symbol is
    first = bwt[behind]
    values = np.full(count, least, np.int32)
    border = np.concatenate(([True], first[1:] != first[:-1]))
    values[border] = 0
    open_ = np.flatnonzero(~border).astype(np.int32)
    left, right = behind[open_ - 1].astype(np.int32), behind[open_].astype(np.int32)
    # Most intervals are one place: what it gets at one level, its extension gets at the next.
    wide = right != left + 1
    extension = np.full(count, -1, np.int32)
    extension[right[~wide]] = open_[~wide]
    open_, left, right = open_[wide], left[wide], right[wide]
    found = np.flatnonzero(border)
    for level in range(1, least):
        found = extension[found]
        found = found[found >= 0]
        if len(open_):
            passed = np.cumsum(border, dtype=np.int32)
            hit = passed[left] != passed[right]
            if hit.any():
                found = np.concatenate((found, open_[hit]))
                rest = ~hit
                open_, left, right = open_[rest], left[rest], right[rest]
        if not len(found):
            break
        values[found] = level
        border[found] = True
    return values


def repeats(
    contexts: list[bytes], docs: np.ndarray, lows: np.ndarray, least: int, copies: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every string of ``least`` bytes in the contexts: the context's number, its
    start there, and whether an earlier (document, start) has the same string; ``docs``
    and ``copies`` name a document."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    symbols = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.uint16) + 1
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols[begins + sizes] = 0
    order, bwt = transform(symbols, least)
    group = np.empty(len(symbols), np.int64)
    group[order] = np.cumsum(common_prefix_values(bwt, least) < least)
    counts = sizes - least + 1
    context = np.repeat(np.arange(len(contexts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    group = group[begins[context] + start]
    # Order of the strings in the corpus, as one number.
    copies = np.zeros(len(docs), np.int64) if copies is None else copies
    by_document = np.lexsort((copies, docs))
    ordered = np.stack((docs[by_document], copies[by_document]))
    changes = np.concatenate(([0], (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)))
    document = np.empty(len(docs), np.int64)
    document[by_document] = np.cumsum(changes)
    place = (document[context] << 40) + lows[context] + start
    earliest = np.full(int(group.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, group, place)
    return context, start, place != earliest[group]


_JUDGED = pa.schema(
    [
        ("doc", pa.int64()),
        ("copy", pa.int64()),
        ("low", pa.int64()),
        ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
        ("digest", pa.binary()),
    ]
)


def _judge(rows: DataFrame, least: int) -> DataFrame:
    """From context rows, each anchor's parts together and each context's first
    occurrence before its others: for the first occurrences the runs of starts that
    repeat; and one row with a ``digest`` for each string of a split anchor that is
    first in its part."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            edges = _changes(table, "anchor", "part")
            # The last group may go on in the next batch; a group has about PART rows.
            cut = int(edges[-1]) if len(edges) > 1 else 0
            if cut:
                yield from _judged(table.slice(0, cut), least)
            held = table.slice(cut)
        if held is not None and len(held):
            yield from _judged(held, least)

    return map_in_arrow(
        rows, task, "doc long, copy long, low long, starts array<int>, ends array<int>, digest binary"
    )


def _changes(table: pa.Table, *names: str) -> np.ndarray:
    """Rows at which a new combination of the columns begins."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for name in names:
        column = table[name].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _may_repeat(contexts: pa.ChunkedArray, at: np.ndarray, group: np.ndarray, least: int) -> np.ndarray:
    """Contexts that agree with another one of their group around the anchor ``at``, as
    far as all strings of some class reach: the others share no string of ``least``
    bytes. A string has its anchor ``d`` bytes behind its start, the same ``d`` wherever
    it occurs; class ``n`` are those with ``d`` in the ``n``-th of ``SIDES`` equal
    parts. Contexts whose windows only have equal hashes are let through."""
    array = contexts.combine_chunks()
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    flat = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    begins, sizes = offsets[:-1].astype(np.int64), np.diff(offsets)
    free = least - GRAM
    shared = np.zeros(len(array), bool)
    for n in range(SIDES):
        left = -(-n * free // SIDES)
        length = left + GRAM + free - (n + 1) * free // SIDES
        has = np.flatnonzero((at >= left) & (at - left + length <= sizes))
        if not len(has):
            continue
        length -= length % 8
        windows = np.lib.stride_tricks.as_strided(flat, (len(flat) - length + 1, length), (1, 1))
        words = windows[begins[has] + at[has] - left].view(np.uint64)
        hashes = group[has].astype(np.uint64) * _A
        for word in words.T:
            hashes = (hashes ^ word) * _C
            hashes ^= hashes >> np.uint64(32)
        _, same, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        shared[has] |= counts[same] > 1
    return shared


def _judged(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """As :func:`_judge`, of whole groups."""
    firsts = table.take(pa.array(_changes(table, "anchor", "part", "context")))
    group = _changes(firsts, "anchor", "part")
    classes = np.diff(np.append(group, len(firsts)))
    several = firsts["parts"].to_numpy() > 1
    number = np.repeat(np.arange(len(group)), classes)
    alone = ~several & ~_may_repeat(firsts["bytes"], firsts["at"].to_numpy(), number, least)
    docs, copies, lows = (firsts[c].to_numpy() for c in ("doc", "copy", "low"))
    if alone.any():
        none = np.empty(0, np.int64)
        yield _runs(docs[alone], copies[alone], lows[alone], np.zeros(alone.sum() + 1, np.int64), none, none)
    left = np.flatnonzero(~alone)
    if not len(left):
        return
    # Blocks of whole groups.
    sizes = pc.binary_length(firsts["bytes"]).to_numpy()[left]
    number = number[left]
    filled = (np.cumsum(sizes) - sizes) // BLOCK_BYTES
    begins = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    block = np.repeat(filled[begins], np.diff(np.append(begins, len(left))))
    cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    for low, high in zip(cuts, np.append(cuts[1:], len(left))):
        rows = left[low:high]
        contexts = firsts["bytes"].take(pa.array(rows)).to_pylist()
        yield from _compared(contexts, docs[rows], copies[rows], lows[rows], several[rows], least)


def _compared(
    contexts: list[bytes],
    docs: np.ndarray,
    copies: np.ndarray,
    lows: np.ndarray,
    split: np.ndarray,
    least: int,
) -> Iterator[pa.RecordBatch]:
    context, start, repeated = repeats(contexts, docs, lows, least, copies)
    edge = np.concatenate(([True], context[1:] != context[:-1]))
    last = np.concatenate((edge[1:], [True]))
    begin = np.flatnonzero(repeated & (edge | ~np.concatenate(([False], repeated[:-1]))))
    end = np.flatnonzero(repeated & (last | ~np.concatenate((repeated[1:], [False]))))
    cut = np.searchsorted(context[begin], np.arange(len(contexts) + 1))
    yield _runs(docs, copies, lows, cut, start[begin], start[end] + least)
    unique = np.flatnonzero(~repeated & split[context])
    if len(unique):
        owner, offset = context[unique], start[unique]
        digests = [
            blake2b(contexts[n][at : at + least], digest_size=16).digest()
            for n, at in zip(owner.tolist(), offset.tolist())
        ]
        nothing = [None] * len(unique)
        yield record_batch(
            _JUDGED, [docs[owner], copies[owner], lows[owner] + offset, nothing, nothing, digests]
        )


def _runs(docs, copies, lows, cuts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(cuts.astype(np.int32))
    columns = [
        pa.array(docs),
        pa.array(copies),
        pa.array(lows),
        pa.ListArray.from_arrays(offsets, pa.array(starts.astype(np.int32))),
        pa.ListArray.from_arrays(offsets, pa.array(ends.astype(np.int32))),
        pa.nulls(len(docs), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_JUDGED)


def _across_parts(judged: DataFrame) -> DataFrame:
    """Repeats that only meet across the parts of a split anchor: ``doc, copy, low``."""
    strings = judged.where("digest is not null").select("digest", "doc", "copy", "low")
    first = (
        strings.groupBy("digest")
        .agg(F.min(F.struct("doc", "copy", "low")).alias("first"), F.count("*").alias("parts"))
        .where("parts > 1")
    )
    later = F.struct("doc", "copy", "low") != F.col("first")
    return strings.join(first, "digest").where(later).select("doc", "copy", "low")


def _spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the intervals."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], begins[1:] > reach[:-1])))
    return begins[new], reach[np.append(new[1:], len(reach)) - 1]


def _removed(
    low: np.ndarray, high: np.ndarray, firsts: pa.StructArray | None, more: list[int], least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of removed bytes of a text: whole contexts (``low`` to ``high``) that
    are no first occurrence, the repeating runs of those that are, and ``more`` single
    strings."""
    begins, ends = [np.array(more, np.int64)], [np.array(more, np.int64) + least]
    if firsts is not None and len(firsts):
        known = firsts.field("low").to_numpy(zero_copy_only=False)
        repeat = ~np.isin(low, known)
        low, high = low[repeat], high[repeat]
        counts = pc.list_value_length(firsts.field("starts")).to_numpy(zero_copy_only=False)
        shift = np.repeat(known, counts)
        begins.append(pc.list_flatten(firsts.field("starts")).to_numpy() + shift)
        ends.append(pc.list_flatten(firsts.field("ends")).to_numpy() + shift)
    begins, ends = np.concatenate([low, *begins]), np.concatenate([high, *ends])
    return _spans(begins, ends) if len(begins) else (begins, ends)


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.binary()),
    ]
)


def _cut(joined: DataFrame, table: np.ndarray, least: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        raws = [raw or b"" for raw in batch.column(1).to_pylist()]
        number, values, _, low, high = runs(raws, least)
        on = _marked(table, values)
        number, low, high = number[on], low[on], high[on] + least
        cut = np.searchsorted(number, np.arange(len(raws) + 1)).tolist()
        keys, firsts, more = batch.column(0).to_pylist(), batch.column(2), batch.column(3)
        for n, raw in enumerate(raws):
            own = slice(cut[n], cut[n + 1])
            begins, ends = _removed(low[own], high[own], firsts[n].values, more[n].as_py() or [], least)
            kept, at = [], 0
            for begin, end in zip(begins.tolist(), ends.tolist()):
                kept.append(raw[at:begin])
                at = end
            kept.append(raw[at:])
            left = b"".join(kept)
            yield keys[n], len(raw), len(raw) - len(left), len(begins), sha256(left).hexdigest(), left

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row for at in range(0, len(batch), _ROWS) for row in rows(batch.slice(at, _ROWS))]
            yield record_batch(_RESULT, list(zip(*found)) or [[] for _ in _RESULT])

    return map_in_arrow(
        joined,
        task,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )


def remove_repeats(
    docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary`` per row;
    ``kept`` holds the bytes that stay."""
    texts = id_and_text(docs, id_col, text_col, binary=True)
    counted = hold(
        _anchor_rows(texts, least)
        .groupBy("anchor")
        .agg(F.sum("uses").alias("uses"))
        .where("uses > 1"),
        "anchors",
    )
    table = _bit_table(counted)
    hot = hold(
        counted.where(F.col("uses") > PART).select(
            "anchor", F.ceil(F.col("uses") / PART).cast("int").alias("parts")
        ),
        "hot-anchors",
    )
    rows = _context_rows(texts, table, least).join(hot, "anchor", "left")
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.select(
        "anchor",
        F.pmod(F.col("context"), parts.cast("long")).cast("int").alias("part"),
        parts.alias("parts"),
        "context", "doc", "copy", "low", "at", "bytes",
    )
    dealt = dealt.repartition("anchor", "part").sortWithinPartitions(
        "anchor", "part", "context", "doc", "copy", "low"
    )
    judged = hold(_judge(dealt, least), "judged")
    firsts = judged.where("digest is null").select(
        "doc", "copy", F.struct("low", "starts", "ends").alias("first"), F.lit(None).cast("long").alias("more")
    )
    nothing = F.lit(None).cast(firsts.schema["first"].dataType)
    more = _across_parts(judged).select("doc", "copy", nothing.alias("first"), F.col("low").alias("more"))
    per_doc = (
        firsts.union(more)
        .groupBy("doc", "copy")
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("more").alias("more"))
    )
    keyed = texts.withColumns({"doc": F.coalesce("doc_id", F.lit(_NO_ID)), "copy": F.xxhash64("text")})
    joined = keyed.join(per_doc, ["doc", "copy"], "left").select("doc_id", "text", "firsts", "more")
    return _cut(joined, table, least)
