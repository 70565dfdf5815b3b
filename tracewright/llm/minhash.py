"""Near-duplicates by signature-coordinate inverted join (operator 10).

A document's set is its distinct two-word shingles. Its signature has ``K``
min-hash coordinates, each a (coordinate, value) pair under which the document is
posted. Two documents with similarity 0.8 share 0.8 K pairs on average, and fewer
than ``MATCHES`` once in some 100,000 such pairs of documents; a pair of documents
is retained if it shares that many, and its link is confirmed on the full sets.

- *Prefix.* Posted pairs are ordered by how many documents they have, rarest first.
  Documents that share ``MATCHES`` of ``K`` pairs share one of their first
  ``K - MATCHES + 1``, so only that prefix is posted. Pairs with one document count
  for the prefix and are never posted.
- *Skip.* The long lists beyond the prefix are not merged: the collisions of a pair
  of documents found in the prefix are counted on the two signatures.
- *Sketch.* A posting carries the size of its document's set and four bits of each
  coordinate. Documents whose sizes rule a link out, or whose sketches show more
  different coordinates than are allowed, make no pair; that loses no pair with enough
  collisions, and keeps hardly any other.
- *Copies* with equal sets are one class, posted once.
- *Hot lists.* A list's documents are compared with two of them, its centres, not with
  each other. Confirmed links make components.
- *Teams.* Documents that collide with a common centre in two thirds of ``MATCHES``,
  linked or not, are a team, so that a large group too far apart to be retained with its
  centres is one as well. A team that spans components is compared whole, on its full
  sets, as matrix products of parts of about ``ROOM`` shingles inside tasks. What leaves
  a task joins each document with one other, so a large group of documents around or
  below the threshold makes no pairs. Parts of one component are not compared with each
  other.
- *The rest.* Documents of different teams that still share a list are paired in lists
  cut by size, so that no link goes unseen.

Defined results: null and empty texts have an empty set, are their own component
and are kept. Every row counts: rows that share an id and have different texts are
linked by their own texts; rows with a null id link as well, but are never kept and
never name a component, which is null where no member has an id. Repeated rows share
their component and verdict. Extra columns are ignored, or carried as they are by
:func:`one_of_each_group`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tracewright.llm.common import fresh, hold, id_and_text, record_batch
from tracewright.llm.components import components, first_connected
from tracewright.session import map_in_arrow, planned_bytes

K = 64
MATCHES = 36
#: Sketch columns; each has one bit of the first 64 coordinates.
PLANES = ("sketch0", "sketch1", "sketch2", "sketch3")
#: Sets of one size class differ by less than this factor, so linked ones are in the
#: same class or in neighbouring ones (they differ by 1.25 at most).
_CLASS = 1.2501
#: Shingles of a part of a team, and the least that a document counts for.
ROOM, LEAST_WEIGHT = 1 << 17, 150
#: Bytes of keys, as written, that are broadcast to fetch their texts.
LIGHT = 64 << 20
#: Columns of a matrix of shingles multiplied at once.
_COLUMNS = 2048
#: Links join documents with PERCENT * union <= 100 * intersection.
PERCENT = 80
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def words(raw: bytes | None) -> list[bytes]:
    """Lower-cased words; `bytes` methods know ASCII letters and spaces only."""
    return raw.lower().split() if raw else []


def shingles(raw: bytes | None, width: int) -> set[tuple[bytes, ...]]:
    found = words(raw)
    if len(found) <= width:
        return {tuple(found)} if found else set()
    return set(zip(*(found[n:] for n in range(width))))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(raw: bytes | None, width: int, known: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    found = words(raw)
    single = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    if not len(single):
        return single
    count = max(1, len(single) - width + 1)
    mixed = np.full(count, np.uint64(min(width, len(single))))
    for n in range(min(width, len(single))):
        mixed = (mixed ^ single[n : n + count]) * _ODD
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed * _SECOND)


def coordinates(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    return (
        draw.integers(0, 1 << 64, k, np.uint64),
        draw.integers(0, 1 << 64, k, np.uint64) | np.uint64(1),
    )


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("key", pa.binary()),
        ("n_shingles", pa.int64()),
        ("digest", pa.binary()),
        *[(plane, pa.int64()) for plane in PLANES],
        ("signature", pa.list_(pa.int32())),
    ]
)
#: Texts signed together, in bytes.
_TOGETHER = 4 << 20


def _signed(texts: list[bytes | None], width: int, flips: np.ndarray, odds: np.ndarray) -> list[list]:
    """Size, digest, sketches and signature of each text's set."""
    known = _Hashes()
    sets = [shingle_hashes(t, width, known) for t in texts]
    sizes = [len(s) for s in sets]
    full = [n for n, size in enumerate(sizes) if size]
    signature: list = [None] * len(sets)
    planes: list[list] = [[None] * len(sets) for _ in PLANES]
    if full:
        flat = np.concatenate([sets[n] for n in full])
        starts = np.concatenate(([0], np.cumsum([sizes[n] for n in full])[:-1]))
        rows = np.empty((len(full), len(flips)), np.int32)
        for c in range(len(flips)):
            mixed = flat ^ flips[c]
            mixed *= odds[c]
            least = np.minimum.reduceat(mixed, starts) >> np.uint64(32)
            rows[:, c] = least.astype(np.uint32).view(np.int32)
        for at, plane in enumerate(planes):
            bits = np.zeros((len(full), 64), np.uint8)
            bits[:, : min(64, rows.shape[1])] = (rows[:, :64] >> at) & 1
            packed = np.packbits(bits, axis=1).view(">i8").ravel()
            for n, short in zip(full, packed.tolist()):
                plane[n] = short
        for n, row in zip(full, rows):
            signature[n] = row
    digests = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
    return [sizes, digests, *planes, signature]


def signatures(docs: DataFrame, width: int, k: int = K, seed: int = 5) -> DataFrame:
    """``doc_id, key, n_shingles, digest``, the sketches and ``signature`` of ``(doc_id,
    text, key)``; the digest stands for the whole set and is null, as are sketches and
    signature, if that is empty."""
    flips, odds = coordinates(k, seed)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            cuts = [0, *np.flatnonzero(np.diff(size // _TOGETHER)) + 1, batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                part = batch.slice(begin, end - begin)
                found = _signed(part.column(1).to_pylist(), width, flips, odds)
                yield record_batch(_SIGNED, [part.column(0), part.column(2), *found])

    return map_in_arrow(
        docs,
        task,
        "doc_id long, key binary, n_shingles long, digest binary, "
        + "".join(f"{plane} long, " for plane in PLANES)
        + "signature array<int>",
    )


def postings(reps: DataFrame, k: int, matches: int) -> DataFrame:
    """``pair, doc`` and what else ``reps`` has: every document under the shared pairs
    of its prefix."""
    own = [c for c in reps.columns if c not in ("doc_id", "signature")]
    # Only numbers travel for each pair; the rest of a row joins what its prefix keeps.
    posted = reps.select(F.col("doc_id").alias("doc"), F.posexplode("signature").alias("place", "value")).select(
        "doc",
        F.shiftleft(F.col("place").cast("long"), 32)
        .bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        .alias("pair"),
    )
    shared = posted.groupBy("pair").count().where("count > 1")
    prefix = k - matches + 1
    # Dealt by document before they are collected: lists of one pair would be larger.
    ordered = (
        posted.join(shared, "pair")
        .repartition("doc")
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.struct("count", "pair"))).alias("pairs"))
    )
    # The pairs of one document alone come first in its order.
    room = prefix - (k - F.size("pairs"))
    kept = ordered.where(room > 0).select("doc", F.slice("pairs", F.lit(1), room).alias("pairs"))
    if own:
        kept = kept.join(reps.select(F.col("doc_id").alias("doc"), *own), "doc")
    return kept.select("doc", *own, F.explode("pairs").alias("p")).select(
        F.col("p.pair").alias("pair"), "doc", *own
    )


def _light(df: DataFrame) -> DataFrame:
    """``df`` for a join with a larger table: broadcast up to ``LIGHT``, which spares
    that table a shuffle."""
    return F.broadcast(df) if planned_bytes(df) <= LIGHT else df


def _retained(pairs: DataFrame, reps: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sizes allow a link and whose signatures collide
    in ``matches`` coordinates or more, and in how many."""
    ends = _light(hold(_ends(pairs), "ends"))
    side = hold(reps.select("doc_id", "n_shingles", "signature").join(ends, "doc_id"), "signatures")
    a = side.toDF("a", "size_a", "signature_a")
    b = side.toDF("b", "size_b", "signature_b")
    least, most = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    equal = F.zip_with("signature_a", "signature_b", lambda x, y: (x == y).cast("int"))
    collisions = F.aggregate(equal, F.lit(0), lambda total, x: total + x)
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .where(100 * least >= percent * most)
        .select("a", "b", collisions.alias("collisions"))
        .where(F.col("collisions") >= matches)
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are as similar as a link needs."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b, first, second in zip(*batch.columns):
                one, two = shingles(first.as_py(), width), shingles(second.as_py(), width)
                both = len(one & two)
                if 100 * both >= percent * (len(one) + len(two) - both):
                    kept.append((a.as_py(), b.as_py()))
            yield record_batch(schema, [[p[0] for p in kept], [p[1] for p in kept]])

    joined = (
        pairs.join(texts.toDF("a", "text_a"), "a")
        .join(texts.toDF("b", "text_b"), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return map_in_arrow(joined, task, "a long, b long")


def _compatible(a: str, b: str, percent: int, differing: int) -> Column:
    """Whether the sizes of two postings allow a link, and their sketches no more than
    ``differing`` different coordinates."""
    sizes = [F.col(f"{side}n_shingles") for side in (a, b)]
    apart = [F.col(f"{a}{plane}").bitwiseXOR(F.col(f"{b}{plane}")) for plane in PLANES]
    seen = F.bit_count(reduce(Column.bitwiseOR, apart))
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (seen <= differing)


def _labelled(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return posted.withColumn("label", F.col("doc"))
    return posted.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "label", F.coalesce("label", "doc")
    )


def _open_lists(posted: DataFrame) -> DataFrame:
    """Postings of the lists that still span components."""
    spans = posted.groupBy("pair").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return posted.join(spans.where("low < high").select("pair"), "pair")


def _with_centre(posted: DataFrame, centre: str, percent: int, differing: int) -> DataFrame:
    """Each list's documents paired with one of them."""
    rank = F.col("doc") if centre == "smallest" else F.xxhash64("doc")
    order = F.struct(rank.alias("rank"), "doc", "label", "n_shingles", *PLANES)
    centres = posted.groupBy("pair").agg(F.min(order).alias("c"))
    paired = posted.join(centres, "pair").where("label <> c.label")
    near = _compatible("", "c.", percent, differing)
    return paired.where(near).select(F.col("c.doc").alias("a"), F.col("doc").alias("b"))


def _all_across(posted: DataFrame, percent: int, differing: int) -> DataFrame:
    """The documents of each list that have different labels, in lists of a size class
    and the one above."""
    step = F.floor(F.log(F.col("n_shingles")) / float(np.log(_CLASS)))
    sized = posted.withColumn("step", step)
    names = ["doc", "label", "n_shingles", *PLANES]
    home = sized.select("pair", "step", *[F.col(c).alias(f"a_{c}") for c in names])
    other = sized.select(
        "pair",
        F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step"),
        F.col("step").alias("own"),
        *[F.col(c).alias(f"b_{c}") for c in names],
    )
    # Of two documents in one class, the smaller label asks.
    asks = (F.col("a_label") < F.col("b_label")) | (
        (F.col("own") < F.col("step")) & (F.col("a_label") != F.col("b_label"))
    )
    paired = home.join(other, ["pair", "step"]).where(asks & _compatible("a_", "b_", percent, differing))
    return paired.select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"))


def _with_texts(nodes: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text`` of the classes ``nodes(doc_id)``, one of their rows' texts each."""
    asked = hold(reps.select("doc_id", "key").join(nodes, "doc_id").withColumnRenamed("doc_id", "node"), "asked")
    # Few keys travel to the texts; many meet them in a shuffle.
    return hold(docs.join(_light(asked), "key").groupBy("node").agg(F.min("text").alias("text")), "texts")


def shared_counts(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``first`` shares with each of ``second``."""
    sizes = np.array([len(s) for s in (*first, *second)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, uses = np.unique(np.concatenate([*first, *second]), return_inverse=True, return_counts=True)
    several = uses > 1
    kept = several[column]
    owner, column = owner[kept], (np.cumsum(several) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(first), len(second)))
    cuts = np.searchsorted(column, np.arange(0, several.sum() + _COLUMNS, _COLUMNS))
    for begin, end in zip(cuts, cuts[1:]):
        held = np.zeros((len(sizes), _COLUMNS), np.float32)
        held[owner[begin:end], column[begin:end] % _COLUMNS] = 1
        total += held[: len(first)] @ held[len(first) :].T
    return total


def _within_teams(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b``: links that connect what is linked inside each team of ``members(node,
    team, label, n_shingles)``, found on the full sets of ``texts(node, text)``."""
    weight = F.greatest("n_shingles", F.lit(LEAST_WEIGHT))
    of_label = members.groupBy("team", "label").agg(F.sum(weight).alias("weight"))
    # A large component has parts of its own, the others share theirs.
    sized = of_label.withColumn("whose", F.when(F.col("weight") > ROOM // 2, F.col("label")).otherwise(-1))
    room = hold(
        sized.groupBy("team", "whose").agg(F.ceil(F.sum("weight") / ROOM).cast("long").alias("parts")), "rooms"
    )
    owned = sized.select("team", "label", "whose")
    placed = (
        members.join(owned, ["team", "label"])
        .join(room, ["team", "whose"])
        .select("node", "team", "label", "whose", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    )
    placed = _light(hold(placed, "placed"))
    name = ["team", "whose", "part"]
    parts = hold(
        placed.join(texts, "node").groupBy(*name).agg(F.collect_list(F.struct("node", "label", "text")).alias("held")),
        "team_parts",
    )
    a, b = (parts.select("team", F.struct("whose", "part").alias(side)) for side in "ab")
    pairs = a.join(b, "team").where("a <= b and (a.whose <> b.whose or a.whose = -1)")
    first, second = (
        parts.select("team", F.struct("whose", "part").alias(side), F.col("held").alias(f"{side}_held")) for side in "ab"
    )
    joined = pairs.join(first, ["team", "a"]).join(second, ["team", "b"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, *sides in zip(*batch.columns):
                known = _Hashes()
                held = [s.values for s in (sides[:1] if same.as_py() else sides)]
                sets = [[shingle_hashes(t, width, known) for t in h.field(2).to_pylist()] for h in held]
                nodes, labels = (np.concatenate([h.field(n).to_numpy() for h in held]) for n in (0, 1))
                counts = shared_counts(sets[0], sets[-1])
                own, other = (np.array([len(x) for x in s]) for s in (sets[0], sets[-1]))
                linked = (counts > 0) & (100 * counts >= percent * (own[:, None] + other[None, :] - counts))
                split = len(sets[0])
                links = np.zeros((len(nodes), len(nodes)), bool)
                if same.as_py():
                    links[:] = linked
                else:
                    links[:split, split:] = linked
                    links[split:, :split] = linked.T
                links &= labels[:, None] != labels[None, :]
                place = first_connected(links)
                hit = np.flatnonzero(place != np.arange(len(place)))
                if len(hit):
                    yield record_batch(schema, [nodes[hit], nodes[place[hit]]])

    return map_in_arrow(joined.select((F.col("a") == F.col("b")).alias("same"), "a_held", "b_held"), task, "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()


def link_components(
    docs: DataFrame, width: int, percent: int = PERCENT, k: int = K, matches: int = MATCHES
) -> tuple[DataFrame, DataFrame]:
    """From ``(doc_id, text binary, key)``, the key a digest of the text: the signed
    documents, and ``digest, team, component_id`` for every set that occurs. The team is
    a number for the component."""
    signed = hold(signatures(docs, width, k), "signed")
    reps = hold(
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("low"),
            F.min("key").alias("key"),
            F.first("n_shingles").alias("n_shingles"),
            *[F.first(plane).alias(plane) for plane in PLANES],
            F.first("signature").alias("signature"),
        )
        .withColumn("doc_id", F.monotonically_increasing_id()),
        "classes",
    )
    posted = hold(postings(reps.select("doc_id", "n_shingles", *PLANES, "signature"), k, matches), "postings")
    labels = None
    lists = hold(_open_lists(_labelled(posted, None)), "lists")
    if not lists.isEmpty():
        loose = matches * 2 // 3
        first, second = (_with_centre(lists, by, percent, k - loose) for by in ("smallest", "hashed"))
        near = hold(_retained(hold(_ordered(first.union(second)), "pairs"), reps, loose, percent), "near")
        # The texts are fetched once, for the links to centres and for the teams.
        texts = _with_texts(_ends(near), reps, docs)
        kept = near.where(F.col("collisions") >= matches).select("a", "b")
        links = hold(_confirmed(kept, texts, width, percent), "links")
        labels = components(links)
        teams = components(near)
        members = teams.withColumnRenamed("label", "team").join(labels, "node", "left")
        members = members.withColumn("label", F.coalesce("label", "node"))
        spans = members.groupBy("team").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        sizes = reps.select(F.col("doc_id").alias("node"), "n_shingles")
        members = hold(members.join(spans.where("low < high").select("team"), "team").join(sizes, "node"), "members")
        if not members.isEmpty():
            links = links.union(hold(_within_teams(members, texts, width, percent), "links"))
            labels = components(links)
        # Linked documents are of one team, and all links inside teams are known.
        apart = hold(_open_lists(_labelled(posted, teams)), "apart")
        pairs = hold(_ordered(_all_across(apart, percent, k - matches)), "pairs")
        retained = hold(_retained(pairs, reps, matches, percent).select("a", "b"), "retained")
        if not retained.isEmpty():
            more = _confirmed(retained, _with_texts(_ends(retained), reps, docs), width, percent)
            labels = components(links.union(hold(more, "links")))
    classes = reps.select("digest", "low", F.col("doc_id").alias("node"))
    if labels is None:
        return signed, classes.select("digest", F.col("node").alias("team"), F.col("low").alias("component_id"))
    named = hold(classes.join(labels, "node", "left").withColumn("team", F.coalesce("label", "node")), "teams")
    lows = named.where("label is not null").groupBy("team").agg(F.min("low").alias("component_id"))
    alone = named.where("label is null").select("digest", "team", F.col("low").alias("component_id"))
    return signed, alone.union(named.where("label is not null").join(lows, "team").select("digest", "team", "component_id"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    narrow = id_and_text(docs, id_col, text_col, binary=True)
    return narrow.withColumn("key", F.unhex(F.md5("text")))


def near_duplicates(
    docs: DataFrame,
    width: int = 2,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles long, component_id long, kept boolean`` per row."""
    signed, classes = link_components(_keyed(docs, id_col, text_col), width, percent)
    joined = signed.join(classes, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def one_of_each_group(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the row with the
    smallest id. Rows that repeat an id and its text leave one, as do rows that repeat a
    text without an id. Rows whose id is null or stands for several texts have a verdict
    for each text, and stay if no row with an id of its own is in their component."""
    signed, classes = link_components(_keyed(docs, id_col, text_col), width, percent)
    rows = (
        signed.select("doc_id", F.coalesce("key", F.lit(bytearray())).alias("key"), "digest")
        .groupBy("doc_id", "key", "digest")
        .agg(F.count("*").alias("rows"))
        .join(classes.select("digest", "team"), "digest", "left")
    )
    rows = hold(rows, "rows")
    shared = rows.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1").select("doc_id")
    own = shared.select("doc_id", F.lit(False).alias("own"))
    ranked = rows.join(own, "doc_id", "left").withColumn(
        "place",
        F.struct(
            (F.col("doc_id").isNull() | F.col("own").isNotNull()).alias("unclear"),
            F.col("doc_id").isNull().alias("without"),
            "doc_id",
            "key",
            "rows",
        ),
    )
    # A text without words is linked with nothing, and its rows are a group.
    first = ranked.where("team is not null").groupBy("team").agg(F.min("place").alias("place"))
    stay = first.select("place").union(ranked.where("team is null").select("place"))
    names = {c: fresh(docs.columns, c) for c in ("doc_id", "key", "rows")}
    stay = hold(stay.select(*[F.col(f"place.{c}").alias(n) for c, n in names.items()]), "stay")
    number, key = docs[id_col].cast("long"), F.unhex(F.md5(docs[text_col].cast("binary")))
    same = number.eqNullSafe(F.col(names["doc_id"])) & (F.coalesce(key, F.lit(bytearray())) == F.col(names["key"]))
    joined = docs.join(stay, same)
    single = joined.where(F.col(names["rows"]) == 1)
    repeated = joined.where(F.col(names["rows"]) > 1).dropDuplicates([names["doc_id"], names["key"]])
    return single.union(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
