import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.operators.quantiles import grouped_quantiles
from tracewright.operators.skew import salted_join

PROBS = {"p0": 0.0, "p25": 0.25, "median": 0.5, "p95": 0.95, "p100": 1.0}


def check(spark, groups):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v long")
    found = {r.k: r for r in grouped_quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(found) == {k for k, values in groups.items() if values}
    for k, row in found.items():
        assert row.n_values == len(groups[k])
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(groups[k], p), rel=1e-12)


def test_against_numpy(spark):
    rng = random.Random(5)
    check(
        spark,
        {
            "one": [7],
            "two": [1, 10**12],
            "same": [5] * 1000,
            "zeros": [0] * 10 + [1],
            "small": [rng.randrange(100) for _ in range(501)],
            "wide": [rng.randrange(1 << rng.randrange(1, 60)) for _ in range(4000)],
            "narrow": [(1 << 40) + rng.randrange(3000) for _ in range(2000)],
            "edges": [(1 << b) + d for b in range(2, 61) for d in (-1, 0, 1)],
        },
    )


def test_one_group_holds_most_rows(spark):
    hot = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 100_003).alias("v"))
    cold = spark.range(1000).select(F.concat(F.lit("c"), F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    found = {r.k: r for r in grouped_quantiles(hot.union(cold), ["k"], "v", PROBS).collect()}
    values = (np.arange(200_000) * 7919) % 100_003
    assert len(found) == 51
    assert found["hot"]["p95"] == pytest.approx(np.quantile(values, 0.95))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), "id")
    small = spark.range(0, 30, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    salted = salted_join(big, small, ["k"], ["id"], how)
    plain = big.join(small, "k", how)
    assert sorted(map(tuple, salted.select(plain.columns).collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str
    )


def test_salted_join_refuses_outer(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], ["id"], "full_outer")
