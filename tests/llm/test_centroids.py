"""Centroid clustering: partial distances and the whole result by brute force, edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from millrace.llm import centroids


def brute(rows):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:16]
    means = [v for _, v in first]
    dist = lambda v, m: sum((a - b) ** 2 for a, b in zip(v, m, strict=True))
    for turn in range(4):
        own = [min(range(len(means)), key=lambda c: (dist(v, means[c]), c)) for _, v in kept]
        if turn < 3:
            for c in set(own):
                mine = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
                means[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    d = [dist(v, means[c]) for (_, v), c in zip(kept, own, strict=True)]
    return sorted(((i, c, x, sum(y for y, o in zip(d, own, strict=True) if o == c), sum(d), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()) for (i, _), c, x in zip(kept, own, d, strict=True)), key=str)


def result(df):
    return sorted(map(tuple, centroids.cluster_vectors(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_whole_result_by_brute_force(spark, n):
    r = random.Random(n)
    rows = [(k, [r.gauss((k % 5) * (j % 3), 1) for j in range(64)]) for k in range(n)]
    if n > 7:
        rows += rows[:40] + [(k, [float(k % 2)] * 64) for k in range(500, 560)]  # repeated rows and ties
        rows += [(None, [0.5] * 64), (901, None), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [float("nan")] * 64), (906, [float("inf")] + [0.0] * 63), (907, [])]
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], "vec_id long, embedding array<double>, cluster string, v int")
    assert result(df) == brute(rows)


def test_partial_distances_are_exact_and_save_work():
    r = np.random.default_rng(1)
    middles = r.integers(-900, 900, (16, 64)) * (np.arange(64) < 12)
    v = middles[r.integers(0, 16, 3000)] + r.integers(-9, 9, (3000, 64))
    order = np.argsort(-v.var(axis=0), kind="stable")
    cluster, best, work = centroids.nearest(v, middles, order)
    d = ((v[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (cluster == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert work < 0.4 * v.size * 16


def test_ties_go_to_the_smaller_number():
    v = np.zeros((3, 64), np.int64)
    same = np.ones((5, 64), np.int64)
    far = same * 3
    cluster, best, _ = centroids.nearest(v, np.concatenate([far[:1], same, far[:1] * 0 + 1]), np.arange(64))
    assert cluster.tolist() == [1, 1, 1] and best.tolist() == [64, 64, 64]


def test_huge_components(spark):
    rows = [(k, [1e300 * (-1) ** k] * 64) for k in range(40)]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert len(got) == 40 and all(x[2] == 0 for x in got)
