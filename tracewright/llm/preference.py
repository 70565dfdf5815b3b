"""Quality classifier by Bradley-Terry pairwise ranking (operator 7).

A document's strength is a weighted sum of its features. The probability that a
better document is preferred over a worse one is the logistic function of the
difference of their strengths; the weights minimise the logistic loss on the
feature differences of preference pairs, each a document labelled 1 against one
labelled 0. The cut is a quantile of the strengths of the labelled rows: the
share of them that are labelled 0. A score is the logistic function of the
distance from the cut, moved so that the cut scores ``THRESHOLD``.

All labelled rows give the means, the pairs and the cut, as Spark jobs: rows are dealt
to cells by a hash, and in a cell every row of the label that has more of them meets
``ROUNDS`` rows of the other, so that every row is in a pair. The score sees the text only.

Defined results: null and empty texts are scored as texts without words. Without
both labels every score is the share of label 1, or 0.5.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewright.llm.common import hold
from tracewright.llm.features import (
    QUALITY_FEATURES,
    featured,
    labelled_features,
    quality_features,
)
from tracewright.operators.quantiles import grouped_quantiles

THRESHOLD = 0.3
PAIRS = 60_000
STEPS = 400
RIDGE = 1e-4
#: Rows of the rarer label in a cell, and pairs of each row of the other.
CELL = 1_000
ROUNDS = 4
#: Steps between the least and the largest strength in which the cut is found.
_STEPS = 1 << 40


class Ranking:
    """Weights on standardised features, and the strength at the cut."""

    def __init__(self, mean, scale, weights, cut: float, flat: float | None = None) -> None:
        self.mean, self.scale, self.weights, self.cut, self.flat = mean, scale, weights, cut, flat

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(rows), self.flat)
        shift = math.log(THRESHOLD / (1 - THRESHOLD))
        return 1.0 / (1.0 + np.exp(-np.clip(self.strength(rows) - self.cut + shift, -500, 500)))


def rank(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, seed: int = 3) -> Ranking:
    """The weights that best explain label 1 winning over label 0."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return Ranking(0, 1, 0, 0.0, flat=float(labels.mean()) if len(labels) else 0.5)
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    scaled = np.clip((rows - mean) / scale, -8, 8)
    draw = np.random.default_rng(seed)
    count = min(pairs, 20 * max(len(good), len(bad)))
    margin = scaled[draw.choice(good, count)] - scaled[draw.choice(bad, count)]
    weights = np.zeros(rows.shape[1])
    moment, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        lose = 1.0 / (1.0 + np.exp(np.clip(margin @ weights, -500, 500)))
        slope = -(margin * lose[:, None]).mean(0) + RIDGE * weights
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        pace = 0.1 * moment / (1 - 0.9**step)
        weights = weights - pace / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    cut = float(np.quantile(scaled @ weights, len(bad) / len(rows)))
    return Ranking(mean, scale, weights, cut)


def _scaled(mean: np.ndarray, scale: np.ndarray) -> Column:
    """The standardised features of a row."""
    parts = [
        F.least(F.greatest((F.col("features")[n] - float(m)) / float(s), F.lit(-8.0)), F.lit(8.0))
        for n, (m, s) in enumerate(zip(mean, scale))
    ]
    return F.array(*parts)


def paired(rows: DataFrame, rarer: int) -> DataFrame:
    """``margin array<double>``, the features of a row labelled 1 less those of one
    labelled 0, for pairs of ``(doc_id, label, scaled)`` that every row is in; ``rarer``
    is how many rows the rarer label has."""
    cells = max(1, rarer // CELL)
    dealt = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(cells)))
    order = Window.partitionBy("cell", "label").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "scaled")
    placed = dealt.withColumn("place", F.row_number().over(order) - 1)
    counts = dealt.groupBy("cell").agg(
        F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")
    )
    placed = placed.join(counts.withColumn("few", F.least("good", "bad")).where("few > 0"), "cell")
    # The label with more rows asks; with as many of both, label 1.
    many = F.when(F.col("good") >= F.col("bad"), 1).otherwise(0)
    turns = F.least(F.lit(ROUNDS), F.col("few")).cast("int")
    asking = placed.where(F.col("label") == many).select(
        "cell", "label", "scaled", F.explode(F.transform(F.sequence(F.lit(1), turns), lambda r: F.pmod(F.col("place") + r, "few"))).alias("slot")
    )
    asked = placed.where(F.col("label") != many).select("cell", F.col("place").cast("long").alias("slot"), F.col("scaled").alias("other"))
    sign = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    joined = asking.join(asked, ["cell", "slot"]).withColumn("sign", sign)
    return joined.select(F.zip_with("scaled", "other", lambda x, y: F.col("sign") * (x - y)).alias("margin"))


def _cut(strengths: DataFrame, share: float) -> float:
    """The quantile of ``strength`` at ``share``, counted over all rows."""
    low, high = strengths.agg(F.min("strength"), F.max("strength")).first()
    if high <= low:
        return low
    step = F.floor((F.col("strength") - low) / (high - low) * float(_STEPS)).cast("long")
    found = grouped_quantiles(strengths.select(F.lit(0).alias("all"), step.alias("step")), ["all"], "step", {"cut": share})
    return low + found.first()["cut"] * (high - low) / _STEPS


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Ranking:
    """A ranking learned from all ``labels`` of ``docs``."""
    found = labelled_features(docs.select("doc_id", "text"), labels, label_col, lambda: quality_features, binary=True)
    rows = hold(found, "labelled")
    width = range(len(QUALITY_FEATURES))
    told = rows.agg(
        F.count_if(F.col("label") == 1).alias("good"),
        F.count_if(F.col("label") == 0).alias("bad"),
        *[f(F.col("features")[n]).alias(f"{name}_{n}") for name, f in (("m", F.avg), ("s", F.stddev_pop)) for n in width],
    ).first()
    total = told.good + told.bad
    if not told.good or not told.bad:
        return Ranking(0, 1, 0, 0.0, flat=told.good / total if total else 0.5)
    mean = np.array([told[f"m_{n}"] for n in width])
    scale = np.array([told[f"s_{n}"] for n in width]) + 1e-6
    scaled = rows.select("doc_id", "label", _scaled(mean, scale).alias("scaled"))
    # Each pair both ways round: the same loss, and always both outcomes.
    both = hold(paired(scaled, min(told.good, told.bad)), "pairs").select(
        "margin", F.explode(F.array(F.lit(1.0), F.lit(0.0))).alias("label")
    )
    margins = both.select(
        array_to_vector(F.transform("margin", lambda x: x * (2 * F.col("label") - 1))).alias("features"), "label"
    )
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=RIDGE, maxIter=100).fit(margins)
    weights = model.coefficients.toArray()
    strength = sum((F.col("scaled")[n] * float(w) for n, w in enumerate(weights)), F.lit(0.0))
    cut = _cut(scaled.select(strength.alias("strength")), told.bad / total)
    return Ranking(mean, scale, weights, float(cut))


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``doc_id, score double, predicted int`` of every row."""

    def scorer():
        return lambda texts: ranking.score(quality_features(texts))[:, None]

    found = featured(docs, scorer, binary=True)
    value = F.element_at("features", 1)
    return found.select(
        "doc_id", value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted")
    )
