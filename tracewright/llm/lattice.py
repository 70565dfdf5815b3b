"""Near-duplicate vectors by E8 lattice hashing (operator 12).

Vectors with equal labels are linked where their cosine, in double precision, reaches
``COSINE``. Candidates come from cells of the E8 lattice:

- *Tables.* Each of ``TABLES`` random projections maps the unit vector to two points of
  eight dimensions, each decoded to the nearest E8 lattice point; the two points and the
  label are the cell. All rows are hashed.
- *Probes.* A vector is posted in its own cell and in the ``PROBES - 1`` cells around it
  that lie nearest, found among the 240 neighbours of each lattice point. Two vectors are
  candidates if any of their cells agree: about 76 % of the pairs of cosine 0.98 in one
  table, 99 % in three, and nearly all of closer ones. Unrelated vectors share a cell of
  a table about once in 10^7 pairs.
- *Classes.* Equal vectors are one class, whose size counts for its neighbours.
- *Groups.* Classes in one cell of the first table are a group. Cells list groups, not
  vectors, so a crowd of near copies makes pairs of its few groups, not of its vectors.
- *Verification.* All vectors of candidate groups are compared, in blocks of ``BLOCK``
  vectors as matrix products inside a task. What leaves a task is, for each class, how
  many links it has and one class it is connected with; pairs of vectors are never rows.
- *Hot groups* are dealt over blocks by a hash before they are gathered.

Defined results: a vector that is null, empty or zero, holds a null or a non-finite
component, or has no label links with nothing, has no links and is its own component.
Vectors of different lengths never link. Every row is a vector of its own: repeated rows
are links of each other and share their component; rows with a null id link, but are never
kept and name no component, which is null where no member has an id. Scale does not
matter; negative zero is zero.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracewright.llm.common import hold, record_batch
from tracewright.llm.components import components, first_connected
from tracewright.session import map_in_arrow

COSINE = 0.98
TABLES = 3
PROBES = 8
#: Scale of the projections: cells shrink as it grows. Unrelated unit vectors share one
#: of (4 pi SCALE^2)^8 cells or so.
SCALE = 1.0
#: Vectors compared at once.
BLOCK = 1024
_SIDE = 8
_SEED = 12


def decode_e8(points: np.ndarray) -> np.ndarray:
    """The E8 lattice point nearest to each row: integers with an even sum, or such
    integers shifted by a half, whichever is nearer."""

    def even(rows: np.ndarray) -> np.ndarray:
        near = np.rint(rows)
        left = rows - near
        odd = np.flatnonzero(near.sum(axis=1) % 2)
        worst = np.abs(left[odd]).argmax(axis=1)
        near[odd, worst] += np.where(left[odd, worst] >= 0, 1.0, -1.0)
        return near

    whole, half = even(points), even(points - 0.5) + 0.5
    nearer = ((points - half) ** 2).sum(axis=1) < ((points - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


@cache
def around() -> np.ndarray:
    """The origin and the 240 lattice points nearest to it."""
    pairs = [
        [a if n == i else b if n == j else 0.0 for n in range(_SIDE)]
        for i, j in itertools.combinations(range(_SIDE), 2)
        for a in (-1.0, 1.0)
        for b in (-1.0, 1.0)
    ]
    halves = [s for s in itertools.product((-0.5, 0.5), repeat=_SIDE) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([[0.0] * _SIDE, *pairs, *halves])


def cells(unit: np.ndarray, salt: np.ndarray, table: int, scale: float, probes: int) -> np.ndarray:
    """Hashes of each unit vector's cell and of the nearest cells around it, nearest
    first. ``salt`` keeps labels apart."""
    draw = np.random.default_rng((_SEED, table, unit.shape[1]))
    projection = draw.normal(size=(unit.shape[1], 2 * _SIDE)) * scale
    shift = draw.random(2 * _SIDE)
    odds = draw.integers(0, 1 << 64, 2 * _SIDE + 2, np.uint64) | np.uint64(1)
    steps = around()
    gaps, hashes = [], []
    for begin in (0, _SIDE):
        point = unit @ projection[:, begin : begin + _SIDE] + shift[begin : begin + _SIDE]
        own = decode_e8(point)
        gap = (steps**2).sum(axis=1) - 2 * (point - own) @ steps.T
        near = np.argsort(gap, axis=1, kind="stable")[:, :probes]
        gaps.append(np.take_along_axis(gap, near, 1))
        twice = np.rint(2 * (own[:, None, :] + steps[near])).astype(np.int64).view(np.uint64)
        hashes.append((twice * odds[begin : begin + _SIDE]).sum(axis=2))
    both = (gaps[0][:, :, None] + gaps[1][:, None, :]).reshape(len(unit), -1)
    best = np.argsort(both, axis=1, kind="stable")[:, :probes]
    mixed = (hashes[0][:, :, None] ^ (hashes[1][:, None, :] * odds[-1])).reshape(len(unit), -1)
    mixed = np.take_along_axis(mixed, best, 1) ^ salt[:, None]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * odds[-2]
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


_ROWS = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("digest", pa.binary()), ("vector", pa.binary())]
)


#: Component types in bytes, and the arrays they come from.
_ARRAYS = {"<f4": "array<float>", "<f8": "array<double>"}


def _component(rows: DataFrame, vector_col: str) -> str:
    return "<f4" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"


def vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, digest, vector``: the components' bytes and their digest, both
    null for vectors that link with nothing. Floats stay floats (see ``_component``)."""
    kind = _component(rows, vector_col)
    narrow = rows.select(
        rows[id_col].cast("long").alias("vec_id"),
        F.xxhash64(rows[label_col]).alias("label"),
        F.when(rows[label_col].isNotNull(), rows[vector_col].cast(_ARRAYS[kind])).alias("vector"),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, packed = [], []
            for vector in batch.column(2):
                values = vector.values
                digest = data = None
                if values is not None and len(values) and not values.null_count:
                    found = values.to_numpy() + values.type.to_pandas_dtype()(0)
                    if np.isfinite(found).all() and found.any():
                        data = found.astype(kind).tobytes()
                        digest = blake2b(data, digest_size=16).digest()
                digests.append(digest)
                packed.append(data)
            yield record_batch(_ROWS, [batch.column(0), batch.column(1), digests, packed])

    return map_in_arrow(narrow, task, "vec_id long, label long, digest binary, vector binary")


def _units(packed: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors, as doubles, of equally long ones, without overflow."""
    rows = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


_POSTED = pa.schema([("node", pa.int64()), ("team", pa.int64()), ("cells", pa.list_(pa.int64()))])


def _posted(classes: DataFrame, kind: str, tables: int, probes: int, scale: float) -> DataFrame:
    """``node, team, cells``: each class's group, and all the cells it is posted in."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(2).to_pylist()
            labels = np.array(batch.column(1), np.int64).view(np.uint64)
            sizes = np.array([len(p) for p in packed])
            nodes = np.array(batch.column(0), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                for start in range(0, len(rows), 2 * BLOCK):
                    part = rows[start : start + 2 * BLOCK]
                    unit = _units([packed[n] for n in part], kind)
                    salt = labels[part] + np.uint64(size)
                    found = [cells(unit, salt, t, scale, probes) for t in range(tables)]
                    own = found[0][:, 0]
                    yield record_batch(_POSTED, [nodes[part], own, list(np.concatenate(found, axis=1))])

    return map_in_arrow(
        classes.select("node", "label", "vector"), task, "node long, team long, cells array<long>"
    )


def _pairs(posted: DataFrame) -> DataFrame:
    """``a, b``: groups that some cell lists together, and groups with themselves."""
    # Dealt by cell once: the steps up to the open cells share that exchange.
    listed = posted.select("team", F.explode("cells").alias("cell")).repartition("cell").distinct()
    shared = listed.groupBy("cell").agg(F.min("team").alias("low"), F.max("team").alias("high"))
    open_cells = hold(listed.join(shared.where("low < high").select("cell"), "cell"), "shared_cells")
    other = open_cells.select("cell", F.col("team").alias("b"))
    across = open_cells.withColumnRenamed("team", "a").join(other, "cell").where("a < b").select("a", "b")
    alone = posted.groupBy("team").count().where("count > 1")
    return across.distinct().union(alone.select(F.col("team").alias("a"), F.col("team").alias("b")))


def _parts(posted: DataFrame, classes: DataFrame, pairs: DataFrame, block: int) -> DataFrame:
    """``team, part, members``: the groups of ``pairs`` in parts of ``block`` or so."""
    teams = pairs.select(F.col("a").alias("team")).union(pairs.select("b")).distinct()
    asked = posted.select("node", "team").join(teams, "team")
    crowded = asked.groupBy("team").count().where(F.col("count") > block)
    parts = crowded.select("team", F.ceil(F.col("count") / (block / 2)).alias("parts"))
    dealt = asked.join(parts, "team", "left").select(
        "node", "team", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).alias("part")
    )
    return (
        dealt.join(classes.select("node", "n", "vector"), "node")
        .groupBy("team", "part")
        .agg(F.collect_list(F.struct("node", "n", "vector")).alias("members"))
    )


_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _found(pairs: DataFrame, parts: DataFrame, kind: str, cosine: float) -> DataFrame:
    """``node, links, other``: a class's links to the other classes of one pair of parts,
    and a class of that pair it is connected with."""
    first, second = (
        parts.select(*[F.col(c).alias(side + c) for c in ("team", "part", "members")]) for side in ("a_", "b_")
    )
    joined = (
        pairs.join(first, F.col("a") == F.col("a_team"))
        .join(second, F.col("b") == F.col("b_team"))
        .where("a <> b or a_part <= b_part")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, *sides in zip(*batch.columns):
                members = [s.values for s in (sides[:1] if same.as_py() else sides)]
                nodes, sizes = (np.concatenate([m.field(n).to_numpy() for m in members]) for n in (0, 1))
                packed = [v for m in members for v in m.field(2).to_pylist()]
                split = len(members[0])
                lengths = np.array([len(p) for p in packed])
                links = np.zeros((len(nodes), len(nodes)), bool)
                for length in np.unique(lengths):
                    rows = np.flatnonzero(lengths == length)
                    unit = _units([packed[n] for n in rows], kind)
                    links[np.ix_(rows, rows)] = unit @ unit.T >= cosine
                if not same.as_py():
                    # Within a side, the pair of the side with itself tells.
                    links[:split, :split] = False
                    links[split:, split:] = False
                np.fill_diagonal(links, False)
                hit = np.flatnonzero(links.any(axis=1))
                if len(hit):
                    counts = links[hit] @ sizes
                    other = nodes[first_connected(links)[hit]]
                    yield record_batch(_FOUND, [nodes[hit], counts, other])

    same = F.expr("a = b and a_part = b_part")
    return map_in_arrow(
        joined.select(same.alias("same"), "a_members", "b_members"), task, "node long, links long, other long"
    )


def near_duplicates(
    rows: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links long, component_id long, kept boolean`` of every row."""
    # Cheaper to compute again for the verdicts than to keep.
    kind, found = _component(rows, vector_col), vectors(rows, id_col, vector_col, label_col)
    classes = hold(
        found.where("digest is not null")
        .groupBy("label", "digest", "vector")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector_classes",
    )
    posted = hold(_posted(classes, kind, tables, probes, scale), "posted")
    pairs = hold(_pairs(posted), "pairs")
    links = hold(_found(pairs, _parts(posted, classes, pairs, block), kind, cosine), "links")
    names = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    # Classes without links, most of them, need no name from a neighbour.
    linked = names.join(counted, "node").select("node", "links", F.col("label").alias("team"))
    known = hold(classes.drop("vector").join(linked, "node", "left"), "known")
    lows = known.where("team is not null").groupBy("team").agg(F.min("low").alias("component"))
    alone = known.where("team is null").select("label", "digest", "n", F.lit(0).alias("links"), F.col("low").alias("component"))
    together = known.join(lows, "team").select("label", "digest", "n", "links", "component")
    verdicts = found.drop("vector").join(alone.union(together), ["label", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return verdicts.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
