"""Lattice links against all pairs: exact where found, few missed, crowds counted in full."""

import numpy as np
import pytest

from tracewright.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, node long, team string"


def near(rng, base, count, noise):
    found = base + noise * rng.normal(size=(count, len(base))) / np.sqrt(len(base))
    return found.astype(np.float32)


def table(spark, rows, parts=4):
    plain = [(i, None if v is None else [None if x is None else float(x) for x in v], lab, 1, "x") for i, v, lab in rows]
    return spark.createDataFrame(plain, SCHEMA).repartition(parts)


def brute(rows, cosine=lattice.COSINE):
    usable = [
        lab is not None and v is not None and len(v) > 0
        and all(x is not None and np.isfinite(x) for x in v) and any(x for x in v)
        for _, v, lab in rows
    ]
    links = {n: set() for n in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.asarray(rows[n][1], np.float64) for n in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a].add(b)
                    links[b].add(a)
    found = []
    for n in range(len(rows)):
        seen, open_ = {n}, [n]
        while open_:
            for other in links[open_.pop()] - seen:
                seen.add(other)
                open_.append(other)
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        component = min(ids) if ids else None
        found.append((rows[n][0], len(links[n]), component, rows[n][0] is not None and rows[n][0] == component))
    return sorted(found, key=str)


def result(spark, rows, **options):
    found = lattice.near_duplicates(table(spark, rows), **options)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_decoding_is_nearest():
    rng = np.random.default_rng(1)
    points = 3 * rng.normal(size=(300, 8))
    own = lattice.decode_e8(points)
    assert np.allclose(2 * own, np.rint(2 * own)) and (own.sum(axis=1) % 2 == 0).all()
    gap = ((points - own) ** 2).sum(axis=1)
    for step in lattice.around():
        assert (((points - own - step) ** 2).sum(axis=1) >= gap - 1e-9).all()
    assert len(np.unique(lattice.around(), axis=0)) == 241


@pytest.mark.parametrize("block", [8, lattice.BLOCK])
def test_crowds_and_odd_rows(spark, block):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3, 64))
    rows = [(n, v, 1) for n, v in enumerate(near(rng, base[0], 60, 0.05))]
    rows += [(100 + n, v, 2) for n, v in enumerate(near(rng, base[0], 20, 0.05))]
    rows += [(200 + n, v, 1) for n, v in enumerate(rng.normal(size=(30, 64)).astype(np.float32))]
    rows += [(300 + n, rows[5][1], 1) for n in range(40)] + [(7, rows[5][1], 1), (None, rows[5][1], 1)]
    rows += [(400, 3 * rows[5][1], 1), (401, -rows[5][1], 1)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 64, 1), (503, [float("nan")] * 64, 1), (504, [1.0, None], 1)]
    rows += [(505, rows[5][1], None), (506, [1.0, 2.0], 1), (507, [2.0, 4.0], 1), (508, [-0.0, 1.0], 1), (509, [0.0, 1.0], 1)]
    rows += [(510, [float("inf"), 1.0], 1), (None, None, None), (None, [3.0, 3.0], 5), (None, [3.0, 3.0], 5)]
    assert result(spark, rows, block=block) == brute(rows)


def test_empty(spark):
    assert result(spark, []) == []
    assert result(spark, [(4, None, None)]) == [(4, 0, 4, True)]


def test_recall_of_single_pairs(spark):
    """Pairs from 0.98 up, none helped by a third vector: at least 0.95 are found."""
    rng = np.random.default_rng(3)
    count, size = 1500, 64
    x = rng.normal(size=(count, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(count, size))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    cosine = rng.uniform(0.9801, 0.986, (count, 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * z
    rows = [(2 * n, v, 0) for n, v in enumerate(x)] + [(2 * n + 1, v, 0) for n, v in enumerate(y)]
    rows += [(10_000 + n, 0.975 * v + np.sqrt(1 - 0.975**2) * w, 0) for n, (v, w) in enumerate(zip(x[:200], z[::-1][:200]))]
    found = result(spark, rows)
    assert sum(r[1] for r in found) >= 2 * 0.95 * count
    assert all(r[2] in (r[0], r[0] - 1) for r in found if r[0] < 10_000 and r[1] == 1)
