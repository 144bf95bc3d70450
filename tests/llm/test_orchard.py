"""Centroid clustering against plain loops over all centroids."""

import hashlib
import random

import numpy as np

from cohortlake.llm import orchard
from cohortlake.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, rounds, scale):
    """(id, cluster, distance) of every row and the centroids, by comparing each vector with each centroid."""
    kept = [(i, [int(np.floor(scale * c)) for c in v]) for i, v in rows]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in seeds[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), c in zip(kept, own, strict=True) if c == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def run(spark, rows, k, rounds, scale=16, components=3):
    out, centroids = orchard.clusters(spark.createDataFrame(rows, SCHEMA).repartition(3), Scratch(spark, "test"), k, rounds, "3", components, scale)
    return sorted(map(tuple, out.collect()), key=repr), centroids.tolist()


def test_rounds_equal_plain_loops_with_ties_and_copies(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-3, 3) / 2 for _ in range(3)]) for i in range(300)]  # a coarse grid: many equal distances
    rows += [(500, [0.5, 0.5, 0.5])] * 150 + [(None, [1.0, 1.0, 1.0])] * 3 + [(501 + i, [0.5, 0.5, 0.5]) for i in range(50)]
    for k, rounds in ((1, 2), (8, 4), (40, 2)):
        want, centroids = brute(rows, k, rounds, 16)
        got = run(spark, rows, k, rounds)
        assert got == (sorted(want, key=repr), centroids)


def test_rows_that_take_no_part_and_few_vectors(spark):
    odd = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]), (6, [float("inf"), 0.0, 0.0])]
    rows = [(7, [0.1, -0.1, 0.0]), (8, [5.0, 5.0, 5.0])]
    got, centroids = run(spark, odd + rows, 8, 3)
    assert {r[0] for r in got} == {7, 8} and len(centroids) == 2 and all(r[2] == 0 for r in got)
    assert run(spark, odd, 8, 3) == ([], [])
    large = [(1, [1e7, 0.0, 0.0]), (2, [-1e7, 0.0, 0.0]), (3, [0.0, 2e7, 0.0])]  # beyond exact 64-bit bounds
    assert run(spark, large, 2, 2) == tuple(map(lambda x: x, (sorted(brute(large, 2, 2, 16)[0], key=repr), brute(large, 2, 2, 16)[1])))


def test_the_search_measures_few_centroids():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-5000, 5000, (64, 8))
    x = np.repeat(centroids, 20, axis=0) + rng.integers(-20, 20, (64 * 20, 8))
    at, best, measured = orchard.nearest(x, centroids, *orchard.neighbours(centroids))
    distances = ((x[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    assert (at == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()
    assert measured < 0.4 * distances.size


def test_other_columns_are_not_read(spark):
    rows = [(i, [float(i % 4), 0.0, 1.0], "x", "y") for i in range(20)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, x string, cluster string")
    out, _ = orchard.clusters(df, Scratch(spark, "test"), 2, 2, "3", 3, 16)
    assert out.columns == ["vec_id", "cluster", "distance"] and out.count() == 20
