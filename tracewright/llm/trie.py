"""Prefix trie of conversations from sorted prefixes (operator 11).

Rebuilt conversations are sorted by their turns; conversations that share a prefix
then stand next to each other, and a node of the trie is an interval of that order.

- *Turns* become 20 bytes each: a digest of role and text, and the number of words.
  Texts are read once and travel no further.
- *Order.* Conversations are dealt by ranges of (turns, id), so neither a very common
  first turn nor a third of all conversations with the same turns lands in one task.
- *Intervals.* Each task walks its range in blocks of ``BLOCK`` turns. A block has the
  common prefix of each conversation with the one before (LCP) and a sparse table of
  their range minima. Every candidate prefix (conversation, depth) searches its left
  and its right extent on its own, by halving steps over that table; there is no stack.
  Members, leaves, children and words follow from prefix sums over the extents.
- *Edges.* Only nodes that hold the first or last conversation of a block can reach
  into another block. They carry a key and are merged by it: sums, less what two
  neighbouring blocks both counted.
- *Ends.* The ids of a node's full-length members are in order; where the node may
  reach into another block they are hashed as a stream, one block's ids at a time.

Defined results: rows without a conv_id belong to no conversation and are ignored.
Turns with equal numbers, null numbers first, are ordered by their digest, and repeated
rows are repeated turns. A conversation of any length is one row of 20 bytes a turn.
An empty table has no members, thus no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tracewright.llm.common import hold, record_batch
from tracewright.session import map_in_arrow

#: Turns, and members, that one block handles.
BLOCK = 1 << 18
#: Bytes of a turn: 16 of its digest, 4 of its number of words.
ITEM = 20
#: Conversations that share an opening, and the longest opening.
FAMILY = 20
OPENING = 4
_WORD = r"[^\x20\x09-\x0D]+"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turn(role: Column, text: Column) -> Column:
    digest = F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary"))))
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(_WORD)).cast("long")), 8, "0")
    return F.unhex(F.concat(digest, words))


def sequences(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``base, conv_id, items``: each conversation's turns in order, dealt by family."""
    conv = turns[conv_col].cast("long")
    empty = F.lit("")
    return (
        turns.select(
            (conv - conv % FAMILY).alias("base"),
            conv.alias("conv_id"),
            turns[turn_col].cast("long").alias("turn"),
            _turn(
                F.coalesce(turns[role_col].cast("string"), empty),
                F.coalesce(turns[text_col].cast("string"), empty),
            ).alias("item"),
        )
        .where("conv_id is not null")
        .repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "item"))).alias("items"))
        .select("base", "conv_id", F.transform("items", lambda t: F.hex(t["item"])).alias("items"))
    )


def rebuilt(found: DataFrame) -> DataFrame:
    """``items, conv_id``, where each conversation opens as the first of its family."""
    openings = found.where("conv_id = base").select(
        "base", F.slice("items", 1, OPENING - 1).alias("opening")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING).cast("int")
    own = F.slice("items", taken + 1, F.greatest(F.size("items"), F.lit(1)))
    opening = F.slice(F.coalesce("opening", F.array().cast("array<string>")), F.lit(1), taken)
    return found.join(openings, "base", "left").select(
        F.unhex(F.array_join(F.concat(opening, own), "")).alias("items"), "conv_id"
    )


def sparse_table(values: np.ndarray, pick) -> list[np.ndarray]:
    """``pick`` (minimum) over 1, 2, 4, ... values from each place on."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(pick(levels[-1][:-half], levels[-1][half:]))
    return levels


def right_extent(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last place that shares ``depth`` turns with ``at``; ``levels`` is over LCPs."""
    count, place = len(levels[0]), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        room = place + (1 << k) < count
        least = levels[k][np.where(room, place + 1, 0)]
        place += np.where(room & (least >= depth), 1 << k, 0)
    return place


def left_extent(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First place that shares ``depth`` turns with ``at``."""
    place = at.copy()
    for k in range(len(levels) - 1, -1, -1):
        room = place - (1 << k) >= 0
        least = levels[k][np.where(room, place - (1 << k) + 1, 0)]
        place -= np.where(room & (least >= depth), 1 << k, 0)
    return place


def common_prefixes(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Turns that each conversation shares with the one before; 0 for the first."""
    lcp = np.zeros(len(lens), np.int64)
    both = np.minimum(lens[1:], lens[:-1])
    full = np.flatnonzero(both)
    if len(full):
        size = both[full]
        begins = np.concatenate(([0], np.cumsum(size)[:-1]))
        step = np.arange(size.sum()) - np.repeat(begins, size)
        equal = flat[np.repeat(starts[full], size) + step] == flat[np.repeat(starts[full + 1], size) + step]
        lcp[full + 1] = np.minimum.reduceat(np.where(equal, np.repeat(size, size), step), begins)
    return lcp


def _keys(items: bytes) -> list[bytes]:
    """A key for each prefix, the empty one first."""
    running = hashlib.md5()
    keys = [running.digest()]
    for n in range(0, len(items), ITEM):
        running.update(items[n : n + ITEM])
        keys.append(running.digest())
    return keys


_NODES = pa.schema(
    [
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("block", pa.int64()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("ids", pa.string()),
        ("words_before", pa.int64()),
        ("words_upto", pa.int64()),
        ("closes", pa.bool_()),
        ("is_last", pa.bool_()),
    ]
)
_NODES_DDL = (
    "key binary, parent_key binary, block long, conv_id long, depth long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string,"
    " ids string, words_before long, words_upto long, closes boolean, is_last boolean"
)


def block_nodes(items: list[bytes], members: list[list[int]], block: int) -> pa.RecordBatch:
    """All nodes of one block: distinct ``items`` in order, and the ids that have them."""
    count = len(items)
    lens = np.array([len(s) // ITEM for s in items], np.int64)
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    packed = np.frombuffer(b"".join(items), np.uint8).reshape(-1, ITEM)
    flat = np.ascontiguousarray(packed).view(f"S{ITEM}").ravel()
    words = np.ascontiguousarray(packed[:, 16:]).view(">u4").ravel().astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(words)))
    sizes = np.array([len(m) for m in members], np.int64)
    least = sparse_table(np.array([m[0] for m in members], np.int64), np.minimum)
    lcp = common_prefixes(flat, starts, lens)
    levels = sparse_table(lcp, np.minimum)

    # Candidates: the root, and of each conversation the depths its neighbour lacks.
    fresh = lens - lcp
    first = 1 + np.concatenate(([0], np.cumsum(fresh)[:-1]))
    at = np.concatenate(([0], np.repeat(np.arange(count), fresh)))
    depth = np.arange(len(at)) - first[at] + lcp[at] + 1
    depth[0] = 0
    last = right_extent(levels, at, depth)

    def node(conversation: np.ndarray, deep: np.ndarray) -> np.ndarray:
        owner = left_extent(levels, conversation, deep)
        return np.where(deep == 0, 0, first[owner] + deep - lcp[owner] - 1)

    parent = node(at[1:], depth[1:] - 1)
    total = upto[starts + lens] - upto[starts]
    before = upto[starts[at] + np.maximum(depth - 1, 0)] - upto[starts[at]]

    def summed(values: np.ndarray, start: np.ndarray) -> np.ndarray:
        running = np.concatenate(([0], np.cumsum(values)))
        return running[last + 1] - running[start]

    n_convs = summed(sizes, at)
    reach = summed(sizes * total, at) - n_convs * before
    added = total - (upto[starts + lcp] - upto[starts])
    distinct = total[at] - before + summed(added, at + 1)
    ends_here = np.append(lcp[1:] < lens[:-1], True)
    level = np.frexp(last - at + 1)[1] - 1
    conv = np.empty(len(at), np.int64)
    for k in np.unique(level):
        rows = np.flatnonzero(level == k)
        conv[rows] = np.minimum(least[k][at[rows]], least[k][last[rows] - (1 << k) + 1])

    edge: list[bytes | None] = [None] * len(at)
    for which in sorted({0, count - 1}):
        deep = np.arange(lens[which] + 1)
        for n, key in zip(node(np.full(len(deep), which), deep), _keys(items[which])):
            edge[n] = key
    ends: list[str | None] = [_NO_ENDS] * len(at)
    ids: list[str | None] = [None] * len(at)
    is_last = np.zeros(len(at), bool)
    for n, which in zip(node(np.arange(count), lens), range(count)):
        text = ",".join(map(str, members[which]))
        if edge[n] is not None:
            ends[n], ids[n] = None, text
            is_last[n] = which == count - 1
        else:
            ends[n] = hashlib.sha256(text.encode()).hexdigest()
    above = np.concatenate(([0], parent))
    inner = [edge[n] is None for n in above]
    return record_batch(
        _NODES,
        [
            edge,
            [None if hidden or n == 0 else edge[p] for n, (p, hidden) in enumerate(zip(above, inner))],
            np.full(len(at), block),
            conv,
            depth,
            pa.array(conv[above], pa.int64(), mask=~np.array(inner)),
            n_convs,
            np.bincount(parent, minlength=len(at)),
            summed(ends_here, at),
            reach - distinct,
            ends,
            ids,
            before,
            upto[starts[at] + depth] - upto[starts[at]],
            last == count - 1,
            is_last,
        ],
    )


def _blocks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts a task's sorted conversations into blocks; equal ones stand once in a block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 31
        items: list[bytes] = []
        members: list[list[int]] = []
        turns, ids = 0, 0
        for batch in batches:
            for sequence, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if turns >= size or ids >= size:
                    yield block_nodes(items, members, block)
                    items, members, turns, ids, block = [], [], 0, 0, block + 1
                if not items or items[-1] != sequence:
                    items.append(sequence)
                    members.append([])
                    turns += len(sequence) // ITEM
                members[-1].append(conv)
                ids += 1
        if items:
            yield block_nodes(items, members, block)

    return task


_ENDS = pa.schema([("key", pa.binary()), ("ends", pa.string())])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the ids of each key, whose texts arrive in order of their blocks."""
    key, running = None, None
    for batch in batches:
        done: list[tuple] = []
        for current, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if current != key:
                if running is not None:
                    done.append((key, running.hexdigest()))
                key, running = current, hashlib.sha256(ids.encode())
            else:
                running.update(f",{ids}".encode())
        if done:
            yield record_batch(_ENDS, [list(c) for c in zip(*done)])
    if running is not None:
        yield record_batch(_ENDS, [[key], [running.hexdigest()]])


def _merged(nodes: DataFrame) -> DataFrame:
    """One row per node that touches a block's edge."""
    edge = nodes.where("key is not null")
    span = edge.groupBy("key").agg(F.min("block").alias("begin"), F.max("block").alias("end"))
    parts = edge.drop("ids", "ends_sha256", "parent_conv_id").join(span, "key").withColumn(
        "goes_on", F.col("block") > F.col("begin")
    )
    # What a block's first conversation shares with the block before, and whether its
    # last conversation is a prefix of the next one.
    seams = parts.groupBy(F.col("block").alias("seam")).agg(
        F.max(F.when(F.col("goes_on"), F.struct("depth", "words_upto"))).alias("shared"),
        F.bool_or(F.expr("is_last and end > block")).alias("continued"),
    )
    joined = parts.join(seams, F.col("block") == F.col("seam"))
    twice = F.col("goes_on").cast("long")
    merged = joined.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") - F.when(F.expr("goes_on and shared.depth > depth"), 1).otherwise(0)).alias(
            "n_children"
        ),
        F.sum(F.col("n_leaves") - F.when(F.expr("closes and continued"), 1).otherwise(0)).alias("n_leaves"),
        F.sum(
            F.col("saved_tokens")
            + twice * F.coalesce(F.expr("shared.words_upto - words_before"), F.lit(0))
        ).alias("saved_tokens"),
    )
    texts = edge.where("ids is not null").select("key", "ids", "block")
    ends = map_in_arrow(
        texts.repartition("key").sortWithinPartitions("key", "block"), _ends, "key binary, ends string"
    )
    return merged.join(ends, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends", F.lit(_NO_ENDS))
    )


def nodes_of(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie's nodes from ``items, conv_id``; see :func:`trie` for the columns."""
    ordered = sequences.repartitionByRange("items", "conv_id").sortWithinPartitions("items", "conv_id")
    nodes = hold(map_in_arrow(ordered.select("items", "conv_id"), _blocks(block), _NODES_DDL), "trie_nodes")
    merged = hold(_merged(nodes), "trie_edges")
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    inner = nodes.where("key is null")
    below = inner.where("parent_key is not null").drop("parent_conv_id").select(
        "parent_key", *[c for c in columns if c != "parent_conv_id"]
    )
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (
        inner.where("parent_key is null")
        .select(*columns)
        .unionByName(below.join(parents, "parent_key").select(*columns))
        .unionByName(merged.join(parents, "parent_key", "left").select(*columns))
    )


def trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    long, ends_sha256 string`` of every node of the rebuilt conversations' trie."""
    return nodes_of(hold(rebuilt(sequences(turns, conv_col, turn_col, role_col, text_col)), "rebuilt"))


def oracle() -> str:
    """The same nodes by explicit prefixes, for tables with short conversations."""
    return f"""
WITH turns AS (
  SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS item,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'item': item, 'words': words}} ORDER BY turn NULLS FIRST, item) AS items
  FROM turns GROUP BY conv_id),
taken AS (
  SELECT *, (xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(
      range(1, len(conv_id::VARCHAR) + 1),
      lambda n: [ascii(substr(conv_id::VARCHAR, n, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x)
      ELSE xor(acc >> 1, (acc & 1) * 3988292384::BIGINT) END), 4294967295::BIGINT) % 4)::BIGINT AS h FROM own),
whole AS (
  SELECT t.conv_id, list_concat(coalesce(b.items, [])[1:t.h], t.items[t.h + 1:]) AS items
  FROM taken AS t LEFT JOIN own AS b ON b.conv_id = t.conv_id - t.conv_id % 20),
path AS (
  SELECT conv_id, unnest(range(0, len(items) + 1)) AS depth, items FROM whole),
keyed AS (
  SELECT conv_id, depth, len(items) AS turns, md5(items[1:depth]::VARCHAR) AS node,
    CASE WHEN depth > 0 THEN md5(items[1:depth - 1]::VARCHAR) END AS parent,
    CASE WHEN depth > 0 THEN items[depth].words ELSE 0 END AS words FROM path),
node AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS saved, max(turns) = depth AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends
  FROM keyed GROUP BY node, depth),
below AS (
  SELECT k.node, sum(n.leaf::BIGINT)::BIGINT AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
  FROM node AS n JOIN keyed AS k ON k.conv_id = n.conv_id AND k.depth <= n.depth GROUP BY k.node),
children AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY parent)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, n.ends AS ends_sha256
FROM node AS n JOIN below AS b USING (node) LEFT JOIN node AS p ON p.node = n.parent
LEFT JOIN children AS c ON c.node = n.node
"""
