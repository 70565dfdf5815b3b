"""Connected components of a links table, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tracewright.llm.common import hold


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``: the smallest node reachable.

    Each round points every node at its smallest neighbour, follows the pointers
    twice, and replaces the links by links between the nodes pointed at, so the
    graph shrinks at least by half of its connected nodes a round. All steps are
    aggregates that combine before their shuffle, and joins of two tables with one
    row a node or link; a node with very many links is split by the skew join.
    """
    edges = hold(links.where("a <> b").select("a", "b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        parent = hold(parent.select("node", F.least("node", "label").alias("label")))
        for _ in range(2):
            parent = _followed(parent, parent)
        parent = hold(parent)
        labels = parent if labels is None else hold(_followed(labels, parent))
        # A node pointed at may itself point further: that link stays.
        chains = _followed(parent, parent).join(
            parent.withColumnRenamed("label", "first"), "node"
        ).select(F.col("first").alias("a"), F.col("label").alias("b"))
        moved = _renamed(_renamed(edges, "a", parent), "b", parent).union(chains)
        edges = hold(
            moved.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def _followed(labels: DataFrame, parent: DataFrame) -> DataFrame:
    """``labels`` with each label replaced by what it points at."""
    onward = parent.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return labels.join(onward, "label", "left").select(
        "node", F.coalesce("next", "label").alias("label")
    )


def _renamed(edges: DataFrame, end: str, parent: DataFrame) -> DataFrame:
    names = parent.select(F.col("node").alias(end), "label")
    other = "b" if end == "a" else "a"
    return edges.join(names, end).select(F.col("label").alias(end), other).select("a", "b")


def first_connected(matrix: np.ndarray) -> np.ndarray:
    """For a square matrix of links, the first place each place is connected with."""
    place = np.arange(len(matrix))
    while True:
        least = np.where(matrix, place[None, :], len(place)).min(axis=1, initial=len(place))
        new = np.minimum(place, least)
        new = new[new]
        if (new == place).all():
            return place
        place = new
