"""Joins and ranks that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 16
_SALT = "_salt"


def with_salt(df: DataFrame, spread: Sequence[str | Column], salts: int = SALTS) -> DataFrame:
    """Add a salt in ``[0, salts)`` hashed from ``spread``.

    ``spread`` must vary inside a hot key. A hash, unlike ``rand()``, gives a
    recomputed row its old salt, so a lost executor cannot move rows.
    """
    return df.withColumn(_SALT, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))


def replicate(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """One copy of each row per salt, for the small side of a salted join."""
    return df.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` to a much smaller ``small`` whose keys are unique, splitting
    every key of ``big`` over ``salts`` tasks."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    joined = with_salt(big, spread, salts).join(replicate(small, salts), [*on, _SALT], how)
    return joined.drop(_SALT)
