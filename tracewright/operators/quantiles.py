"""Exact grouped quantiles without a per-group value buffer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewright.session import staged

# Values share a bucket when their leading 13 bits agree, so a group has at
# most 4096 buckets per power of two whatever its row count.
_BUCKET_BITS = 12


def _bucket(value: str) -> Column:
    octave = f"cast(floor(log2(greatest(`{value}`, 1))) as int)"
    bucket = F.expr(
        f"{octave} * {1 << (_BUCKET_BITS + 1)}L"
        f" + shiftright(`{value}`, greatest({octave} - {_BUCKET_BITS}, 0))"
    )
    return F.coalesce(bucket, F.lit(0).cast("long"))


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Interpolated quantiles per group: ``keys, n_values`` and one column per entry
    of ``probs`` (name to probability).

    ``value`` must be a non-negative integer; rows with a null key or value belong to
    no group. Rows are counted per value bucket first, which combines map-side. The
    few buckets that hold a wanted rank are written out: their known size lets Spark
    broadcast them to a second scan if they are few, which leaves only rows of those
    buckets to be counted by value and ranked. No task sees a whole group, and the
    rows as a whole are not shuffled.
    """
    keys = list(keys)
    present = reduce(and_, [F.col(c).isNotNull() for c in (*keys, value)])
    rows = df.where(present).select(*keys, value, _bucket(value).alias("_bucket"))
    by_key = Window.partitionBy(*keys)
    upto_bucket = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    wanted = [
        rank
        for name, p in probs.items()
        for rank in (
            F.floor(F.lit(p) * (F.col("n_values") - 1)).alias(f"_lo_{name}"),
            F.ceil(F.lit(p) * (F.col("n_values") - 1)).alias(f"_hi_{name}"),
        )
    ]
    rank_names = [f"_{side}_{name}" for name in probs for side in ("lo", "hi")]
    holds_rank = [
        (F.col(r) >= F.col("_before")) & (F.col(r) < F.col("_upto")) for r in rank_names
    ]
    buckets = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto_bucket))
        .withColumn("n_values", F.sum("_n").over(by_key))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .select("*", *wanted)
        .where(reduce(or_, holds_rank))
        .drop("_n", "_upto")
    )
    buckets = staged(buckets, "buckets")
    carried = ["_before", "n_values", *rank_names]
    counts = (
        rows.join(buckets, [*keys, "_bucket"])
        .groupBy(*keys, "_bucket", value)
        .agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in carried])
    )
    in_bucket = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        counts.withColumn("_upto", F.col("_before") + F.sum("n").over(in_bucket))
        .withColumn("_before", F.col("_upto") - F.col("n"))
    )

    def at(rank: str) -> Column:
        here = (F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_upto"))
        return F.max(F.when(here, F.col(value))).cast("double")

    def interpolated(name: str, p: float) -> Column:
        low = F.col(f"_v_lo_{name}")
        part = F.lit(p) * (F.col("n_values") - 1)
        step = F.col(f"_v_hi_{name}") - low
        return (low + step * (part - F.floor(part))).alias(name)

    return (
        ranked.groupBy(*keys)
        .agg(
            F.first("n_values").alias("n_values"),
            *[at(rank).alias(f"_v{rank}") for rank in rank_names],
        )
        .select(*keys, "n_values", *[interpolated(name, p) for name, p in probs.items()])
    )

