"""Columns that stay computed once, whatever filters come after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns added behind a one-row generator.

    A filter on an ordinary computed column is pushed below its projection,
    which evaluates the column a second time; a filter on a generator's output
    is not. Use it where the column is a parse.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
