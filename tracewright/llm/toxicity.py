"""Toxicity by gradient-boosted trees over dense features (operator 8).

Features of a text: densities of a fixed lexicon and of one learned from labelled
rows, how near its hits are to second-person words, capitals, punctuation, and
rates of obfuscated spellings. The learned lexicon holds whole words and word
beginnings, as insults inflect. Trees are Spark ML's; an isotonic regression turns
their probability into a calibrated one.

A bounded sample of labelled rows (``features.SAMPLE_ROWS``) is divided by a hash of
the id: one part gives the lexicon, one the trees, one the calibration, so that no
part judges rows it has learned from. The score sees the text only.

Defined results: null and empty texts are scored as texts without words. Without
both labels in a part every score is the share of label 1, or 0.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from tracewright.llm.common import hold, share
from tracewright.llm.features import KEPT, featured, labelled_sample

THRESHOLD = 0.3
#: Common English insults.
LEXICON = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "dumbass", "trash", "garbage",
    "pathetic", "worthless", "disgusting", "clown", "loser", "losers", "scum", "filth", "vermin",
    "bastard", "bitch", "asshole", "shit", "fuck", "fucking", "cunt", "whore", "slut", "retard",
    "retarded", "imbecile", "cretin", "jerk", "freak", "pig", "hate", "kill", "ugly", "shut",
)
#: Second-person words of the four languages.
SECOND_PERSON = frozenset(
    ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr",
     "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted",
     "ustedes", "vosotros", "os", "su")
)
#: Digits and signs that stand for letters.
LEET = str.maketrans("0134578@$!|+", "oieastbasilt")
STEM = (3, 8)
LEAST_ROWS = 6
LEAST_PRECISION = 0.75
MOST_STEMS = 2_000
NEAR = 5
FEATURES = (
    "fixed", "learned", "learned_weight", "fixed_any", "learned_any", "near_you", "nearest_you",
    "you", "upper", "loud_words", "exclaims", "asks", "punctuation", "symbols", "digits",
    "mixed_words", "disguised", "log_words", "learned_log",
)
_EDGES = ".,;:!?\"'()[]{}<>«»“”‘’#*$%&|-_~…"
_MIXED = re.compile(r"[^\W\d_][\d@$!|+*.\-_]+[^\W\d_]")


def plain(word: str) -> str:
    return word.strip(_EDGES).lower()


def _candidates():
    """The distinct normalised words of ``text``, marked whole, and their beginnings."""
    edge = "[" + "".join("\\" + c if c.isascii() else c for c in _EDGES) + "]+"
    words = F.array_distinct(
        F.transform(
            F.split(F.lower("text"), "[ \t\n\x0B\f\r]+"),
            lambda w: F.regexp_replace(w, f"^{edge}|{edge}$", ""),
        )
    )
    stems = F.transform(
        F.sequence(F.lit(STEM[0]), F.lit(STEM[1])),
        lambda n: F.transform(words, lambda w: F.when(F.length(w) > n, F.substring(w, 1, n))),
    )
    whole = F.transform(words, lambda w: F.concat(w, F.lit("$")))
    return F.array_distinct(F.array_compact(F.concat(F.flatten(stems), whole)))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Beginnings and ``word$`` entries that mark label 1 in ``(text, label)``:
    in ``LEAST_ROWS`` such rows, and rarely in others; weighted by log odds."""
    seen = rows.where("text is not null").select("label", F.explode(_candidates()).alias("entry"))
    counted = (
        seen.groupBy("entry")
        .agg(F.sum("label").alias("toxic"), F.count("*").alias("rows"))
        .where((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") >= LEAST_PRECISION * F.col("rows")))
    )
    best = counted.orderBy(F.desc("toxic"), "entry").limit(MOST_STEMS).collect()
    return {r.entry: math.log((r.toxic + 0.5) / (r.rows - r.toxic + 0.5)) for r in best}


class _Words(dict):
    """Per raw word: (fixed hit, learned weight, second person, loud, mixed, disguised)."""

    def __init__(self, learned: dict[str, float]) -> None:
        super().__init__()
        self.learned, self.fixed = learned, frozenset(LEXICON)

    def weight(self, word: str) -> float:
        found = [self.learned.get(word + "$", 0.0)]
        found += [self.learned.get(word[:n], 0.0) for n in range(STEM[0], min(STEM[1], len(word)) + 1)]
        return max(found)

    def __missing__(self, raw: str) -> tuple:
        word = plain(raw)
        fixed, weight = word in self.fixed, self.weight(word)
        disguised = False
        if not fixed and not word.isalpha() and word:
            clear = re.sub(r"[.\-_*]", "", word.translate(LEET))
            disguised = clear in self.fixed
        core = raw.strip(_EDGES)
        found = self[raw] = (
            fixed or disguised,
            weight,
            word in SECOND_PERSON,
            len(core) > 1 and core.isupper(),
            bool(_MIXED.search(core)),
            disguised,
        )
        return found


def toxicity_features(texts: list[str], known: _Words) -> np.ndarray:
    rows = np.zeros((len(texts), len(FEATURES)))
    if len(known) > KEPT:
        known.clear()
    for n, text in enumerate(texts):
        words = (text or "").split()
        if not words:
            continue
        marks = np.array(list(map(known.__getitem__, words)), np.float64)
        fixed, weight, person, loud, mixed, disguised = marks.T
        hits = np.flatnonzero((fixed > 0) | (weight > 0))
        people = np.flatnonzero(person)
        near, gap = 0.0, 50.0
        if len(hits) and len(people):
            at = np.searchsorted(people, hits)
            before = np.abs(hits - people[np.maximum(at - 1, 0)])
            after = np.abs(people[np.minimum(at, len(people) - 1)] - hits)
            gaps = np.minimum(before, after)
            near, gap = float((gaps <= NEAR).sum()), float(min(gaps.min(), 50))
        total, size = len(words), len(text)
        counts = np.bincount(
            np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=128
        )
        learned = weight > 0
        rows[n] = [
            fixed.sum() / total, learned.sum() / total, weight.sum() / total,
            min(fixed.sum(), 5), min(learned.sum(), 5), near / total, gap / 50,
            person.sum() / total, counts[65:91].sum() / size, loud.sum() / total,
            counts[33] / total, counts[63] / total,
            counts[[33, 34, 39, 40, 41, 44, 46, 58, 59, 63]].sum() / size,
            counts[[35, 36, 37, 38, 42, 60, 62, 124]].sum() / size, counts[48:58].sum() / size,
            mixed.sum() / total, disguised.sum() / total, math.log1p(total),
            math.log1p(weight.sum()),
        ]
    return rows


def _maker(learned: dict[str, float]):
    def make():
        known = _Words(learned)
        return lambda texts: toxicity_features(texts, known)

    return make


class Toxicity:
    def __init__(self, learned, trees=None, calibration=None, flat: float = 0.0) -> None:
        self.learned, self.trees, self.calibration, self.flat = learned, trees, calibration, flat


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Toxicity:
    """Lexicon, trees and calibration from the ``labels`` of ``docs``."""
    sample = hold(labelled_sample(docs.select("doc_id", "text"), labels, label_col))
    part = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(10))
    learned = learn_lexicon(sample.where(part < 4))
    # A bounded sample: few partitions suffice for the many passes of the trees.
    rows = hold(
        featured(sample.where(part >= 4), _maker(learned), binary=False, extra="label")
        .select("doc_id", array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
        .coalesce(6)
    )
    trained, rest = rows.where(part < 8), rows.where(part >= 8)
    shares = [p.agg(F.avg("label")).first()[0] for p in (trained, rest)]
    if any(s is None or s in (0.0, 1.0) for s in shares):
        known = [s for s in shares if s is not None]
        return Toxicity(learned, flat=sum(known) / len(known) if known else 0.0)
    trees = GBTClassifier(
        maxIter=25, maxDepth=3, stepSize=0.3, minInstancesPerNode=3, seed=11, maxMemoryInMB=64
    ).fit(trained)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
        _raw(rest, trees)
    )
    return Toxicity(learned, trees, calibration)


def _raw(rows: DataFrame, trees) -> DataFrame:
    found = trees.transform(rows)
    return found.withColumn("raw", vector_to_array("probability")[1])


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``doc_id, score double, predicted int`` of every row."""
    found = featured(docs, _maker(model.learned), binary=False)
    if model.trees is None:
        scored = found.select("doc_id", F.lit(float(model.flat)).alias("score"))
    else:
        vectors = found.select("doc_id", array_to_vector("features").alias("features"))
        scored = model.calibration.transform(_raw(vectors, model.trees)).select("doc_id", "score")
    bounded = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return scored.select(
        "doc_id", bounded.alias("score"), (bounded >= THRESHOLD).cast("int").alias("predicted")
    )
