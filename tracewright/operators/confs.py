"""Configuration maps: layering, defaults, differences."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_EMPTY = "map<string,string>"


def merge_confs(*layers: Column) -> Column:
    """Layers as one map; a later layer's value wins. A null layer is empty."""

    def over(earlier: Column, later: Column) -> Column:
        kept = F.map_filter(earlier, lambda k, v: ~F.map_contains_key(later, k))
        return F.map_concat(kept, later)

    filled = [F.coalesce(layer, F.create_map().cast(_EMPTY)) for layer in layers]
    return reduce(over, filled)


def conf_value(conf: str | Column, key: str, default: str) -> Column:
    """A conf's value, or ``default`` where the key is absent."""
    return F.coalesce(F.try_element_at(conf if isinstance(conf, Column) else F.col(conf), F.lit(key)), F.lit(default))


def with_defaults(conf: str | Column, defaults: Mapping[str, str]) -> Column:
    """The named settings with defaults filled in, as a map."""
    entries = [c for k, d in defaults.items() for c in (F.lit(k), conf_value(conf, k, d))]
    return F.create_map(*entries)


def conf_diff(conf: Column, base: Column) -> Column:
    """Entries of ``conf`` that ``base`` lacks or has another value for."""

    def differs(key: Column, value: Column) -> Column:
        return ~F.map_contains_key(base, key) | ~value.eqNullSafe(F.try_element_at(base, key))

    return F.map_filter(conf, differs)


def exploded(df: DataFrame, conf: Column, id_column: str = "id") -> DataFrame:
    """A conf map as ``id, key, value`` rows."""
    return df.select(F.col(id_column).alias("id"), F.explode(conf).alias("key", "value"))


def setting_leaves(df: DataFrame, config: str, id_column: str = "id") -> DataFrame:
    """A VARIANT config as ``id, path, value``: one row per setting however deep it
    lies, the path an array of keys, the value its JSON text, so that ``true`` and
    ``"true"`` differ. Empty objects are settings of their own; nulls stay null text."""
    is_object = F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT<")
    rows = df.select(
        F.col(id_column).alias("id"), F.array().cast("array<string>").alias("path"), F.col(config).alias("value")
    ).where("value IS NOT NULL")
    found = None
    while True:
        rows = rows.withColumn("inner", is_object & (F.schema_of_variant("value") != "OBJECT<>"))
        leaves = rows.where(~F.col("inner")).select("id", "path", F.to_json("value").alias("value"))
        found = leaves if found is None else found.union(leaves)
        deeper = rows.where("inner").select("id", "path", F.col("value").alias("object"))
        # One job a level; objects hold objects a few times at most.
        if deeper.isEmpty():
            return found
        rows = deeper.lateralJoin(
            deeper.sparkSession.tvf.variant_explode(F.col("object").outer())
        ).select("id", F.array_append("path", F.col("key")).alias("path"), F.col("value").alias("value"))


def typed_diff(df: DataFrame, config: str, base: str, id_column: str = "id") -> DataFrame:
    """``id, path, value``: the settings of ``config`` that ``base`` lacks or has with
    another value or type."""
    ours = setting_leaves(df, config, id_column).withColumn("ours", F.lit(True))
    theirs = setting_leaves(df, base, id_column).withColumn("ours", F.lit(False))
    sides = ours.union(theirs).groupBy("id", "path").agg(
        F.max(F.when(F.col("ours"), F.col("value"))).alias("value"),
        F.max(F.when(~F.col("ours"), F.col("value"))).alias("before"),
        F.bool_or("ours").alias("here"),
    )
    return sides.where(F.col("here") & ~F.col("value").eqNullSafe(F.col("before"))).select("id", "path", "value")
