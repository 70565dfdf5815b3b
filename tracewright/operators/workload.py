"""The generated star-schema workload: fact and dimension tables, the join
chain, staging, caching and output."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracewright.functions.draws import uniform
from tracewright.operators.skew import replicate, with_salt
from tracewright.session import broadcast_limit, planned_bytes, staged, task_count

# Share of rows on the injected hot key, default table sizes.
HOT_SHARE = 0.8
HOT_KEY = 0
DEFAULT_ROW_COUNT = 5_000_000
DEFAULT_CARDINALITY = 1000
DEFAULT_JOIN_TABLES = 2

PERSIST_LEVELS = {
    "memory-only": StorageLevel.MEMORY_ONLY,
    "memory-and-disk": StorageLevel.MEMORY_AND_DISK,
}


def id_range(spark: SparkSession, row_count: int = DEFAULT_ROW_COUNT) -> DataFrame:
    """Row ids ``0 .. row_count - 1`` as ``row_id``."""
    return spark.range(row_count).withColumnRenamed("id", "row_id")


def fact_table(
    ids: DataFrame,
    cardinality: int = DEFAULT_CARDINALITY,
    skew: str = "none",
    payload_columns: int = 0,
    draws: str = "hashed",
    seed: int | None = None,
) -> DataFrame:
    """Fact rows over ``ids`` (a ``row_id`` column): ``row_id, join_key,
    payload_0..``.

    ``skew="none"`` spreads ``join_key`` evenly over ``[0, cardinality)``;
    ``"injected"`` first sends each row to the hot key with probability 0.8.
    ``draws="hashed"`` repeats its values on every run, ``"random"`` uses
    ``rand()``.
    """
    if skew not in ("none", "injected"):
        raise ValueError(f"unknown skew mode {skew!r}")
    if draws not in ("hashed", "random"):
        raise ValueError(f"unknown draw mode {draws!r}")

    def draw(stream: int) -> Column:
        if draws == "hashed":
            return uniform("row_id", stream)
        return F.rand() if seed is None else F.rand(seed + stream)

    key = F.floor(draw(0) * cardinality).cast("long")
    if skew == "injected":
        key = F.when(draw(1) < HOT_SHARE, F.lit(HOT_KEY).cast("long")).otherwise(key)
    payload = [draw(4 + i).alias(f"payload_{i}") for i in range(payload_columns)]
    return ids.select("row_id", key.alias("join_key"), *payload)


def dimension_table(keys: DataFrame, suffix: str) -> DataFrame:
    """One row per ``join_key`` of ``keys``: ``join_key, attr_<suffix>``."""
    attr = F.concat(F.lit(f"val-{suffix}-"), F.col("join_key").cast("string"))
    return keys.select("join_key", attr.alias(f"attr_{suffix}"))


def key_range(spark: SparkSession, cardinality: int = DEFAULT_CARDINALITY) -> DataFrame:
    """Join keys ``0 .. cardinality - 1`` as ``join_key``."""
    return spark.range(cardinality).withColumnRenamed("id", "join_key")


@dataclass(frozen=True)
class Dimension:
    """A dimension table with a unique key, and the fact column it joins on."""

    table: DataFrame
    key: str


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Inner-join ``fact`` to each dimension in turn; Spark picks the strategy
    and broadcasts only what its size threshold admits."""
    joined = fact
    for dimension in dimensions:
        joined = joined.join(dimension.table, dimension.key, "inner")
    return joined


def merged_star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """The star join by plain sort-merge: a hot key stays whole, which is what a
    run meant to show skew in its log needs."""
    joined = fact
    for dimension in dimensions:
        joined = joined.join(dimension.table.hint("merge"), dimension.key, "inner")
    return joined


def affordable_salts(fact: DataFrame, dimensions: Sequence[Dimension]) -> int:
    """One salt per shuffle task, so a hot key can reach all of them, as long as
    each dimension's copies stay under a quarter of the fact by size estimates.
    Beyond that adaptive execution splits what is left."""
    largest = max(planned_bytes(d.table) for d in dimensions)
    affordable = planned_bytes(fact) // (4 * max(largest, 1))
    return max(1, min(task_count(fact.sparkSession), affordable))


def shuffled_star_join(
    fact: DataFrame,
    dimensions: Sequence[Dimension],
    spread: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """The star join by sort-merge with no broadcast, hot keys split by salt.

    All dimensions that share a key column reuse one (key, salt) partitioning
    of the fact, so such a chain shuffles the fact once.
    """
    salts = affordable_salts(fact, dimensions) if salts is None else salts
    joined = with_salt(fact, spread, salts)
    for dimension in dimensions:
        copies = replicate(dimension.table, salts).hint("merge")
        joined = joined.join(copies, [dimension.key, "_salt"], "inner")
    return joined.drop("_salt")


def workload_join(
    fact: DataFrame, dimensions: Sequence[Dimension], spread: Sequence[str]
) -> DataFrame:
    """:func:`star_join` while every dimension is under the broadcast
    threshold, else :func:`shuffled_star_join`."""
    limit = broadcast_limit(fact.sparkSession)
    if all(planned_bytes(d.table) <= limit for d in dimensions):
        return star_join(fact, dimensions)
    return shuffled_star_join(fact, dimensions, spread)


def stage_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table of the session's catalog, its files dealt by a hash of ``key``
    and sorted by it. Joins on the key between tables of equal ``buckets`` then need no
    exchange, however often they are made."""
    writer = df.write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key, *_salt_of(df)).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def _salt_of(df: DataFrame) -> list[str]:
    return ["_salt"] if "_salt" in df.columns else []


def stage_star(
    fact: DataFrame,
    dimensions: Sequence[Dimension],
    spread: Sequence[str],
    name: str,
    path: str,
    buckets: int,
    salts: int | None = None,
) -> tuple[DataFrame, list[Dimension]]:
    """A fact and its dimensions staged once, so that :func:`bucketed_star_join` joins
    them without an exchange. All dimensions must share the fact's key column. A hot key
    is split over ``salts`` buckets by a hash of the ``spread`` columns, for which each
    dimension is copied; by default as far as :func:`affordable_salts` allows."""
    (key,) = {d.key for d in dimensions}
    salts = affordable_salts(fact, dimensions) if salts is None else salts
    staged_fact = stage_bucketed(with_salt(fact, spread, salts), f"{name}_fact", f"{path}/fact", key, buckets)
    copies = [
        Dimension(
            stage_bucketed(replicate(d.table, salts), f"{name}_dim_{n}", f"{path}/dim_{n}", key, buckets), key
        )
        for n, d in enumerate(dimensions)
    ]
    return staged_fact, copies


def bucketed_star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """The star join of :func:`stage_star`'s tables, bucket by bucket."""
    joined = fact
    for dimension in dimensions:
        joined = joined.join(dimension.table.hint("merge"), [dimension.key, "_salt"], "inner")
    return joined.drop("_salt")


def stage_as_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to Parquet and return a scan of it, cutting the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_output(
    df: DataFrame,
    target: str,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Overwrite ``target`` with ``df``. ``iceberg`` creates or replaces the
    table named ``target``; other formats write to it as a path."""
    if table_format == "iceberg":
        df.writeTo(target).using(table_format).createOrReplace()
        return
    df.write.format(table_format).mode("overwrite").partitionBy(*partition_by).save(target)


def persisted(df: DataFrame, mode: str) -> DataFrame:
    """``df`` marked for caching at a named level; ``"none"`` leaves it as is."""
    return df if mode == "none" else df.persist(PERSIST_LEVELS[mode])


def key_counts(df: DataFrame, key: str = "join_key") -> DataFrame:
    """Rows per key: ``join_key, n_rows``."""
    return df.groupBy(F.col(key).alias("join_key")).agg(F.count("*").alias("n_rows"))


def row_count(df: DataFrame, condition: str = "true") -> DataFrame:
    """Rows that satisfy a SQL condition, as one ``n_rows`` row."""
    return df.where(condition).agg(F.count("*").alias("n_rows"))


def run_workload(
    fact: DataFrame,
    dimensions: Sequence[Dimension],
    output: str,
    table_format: str = "parquet",
    persist_mode: str = "none",
    second_action: str = "none",
    staging_path: str | None = None,
    force_merge: bool = False,
) -> DataFrame:
    """One full run: optional Parquet staging, optional caching, the join, the
    write, and a second action over the fact. ``force_merge`` joins by
    :func:`merged_star_join` in place of :func:`workload_join`.

    Returns the second action's result: counts per key (``reread``), a row
    count (``count``), or the joined table as written (``none``).
    """
    if staging_path is not None:
        fact = stage_as_parquet(fact, staging_path)
    fact = persisted(fact, persist_mode)
    if force_merge:
        joined = merged_star_join(fact, dimensions)
    else:
        joined = workload_join(fact, dimensions, ["row_id"])
    write_output(joined, output, table_format)
    again = {"reread": key_counts, "count": row_count}.get(second_action)
    found = None if again is None else staged(again(fact), "second-action")
    if persist_mode != "none":
        fact.unpersist()
    if found is not None:
        return found
    if table_format == "iceberg":
        return fact.sparkSession.table(output)
    return fact.sparkSession.read.format(table_format).load(output)
