"""Exact top-k search against all scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import topk, vectors
from cohortlake.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, top, scale, every):
    kept = [(i, [int(np.floor(scale * c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, q in kept:
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for j, v in kept if j != i]  # noqa: B905  shorter ones end early
        out += [(i, n, j, -s) for n, (s, _, _, j) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def run(spark, rows, top, scale=64, every=4):
    scratch = Scratch(spark, "test")
    table = scratch.table(vectors.integers(spark.createDataFrame(rows, SCHEMA).repartition(3), scale, "vec_id", "embedding"), "vectors")
    return sorted(map(tuple, topk.search(table, F.pmod("vec_id", F.lit(every)) == 0, scratch, top).collect()), key=repr)


@pytest.mark.parametrize("block", [1024, 16])
def test_search_equals_all_scores_with_ties_copies_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SHARE", 4)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(24)]) for i in range(250)]
    rows += [(1000 + i, [0.25] * 24) for i in range(120)]  # copies: nothing but ties
    rows += [(2000, None), (2004, [0.1, None]), (2008, [float("nan")] * 24), (2012, [float("-inf")] * 24)]
    rows += [(2016, [0.5] * 5), (2020, []), (None, [1.0] * 24), (None, [0.25] * 24), (2100, [3.0] * 24), (2101, [0.25] * 30)]
    for top in (1, 20):
        assert run(spark, rows, top) == brute(rows, top, 64, 4)


def test_few_candidates_repeated_ids_and_large_components(spark):
    assert run(spark, [(4, [1.0])], 20) == []
    assert run(spark, [], 20) == []
    assert run(spark, [(4, [1.0, 2.0]), (5, [3.0, 4.0])], 20) == [(4, 1, 5, 64 * 64 * 11)]
    repeated = [(4, [1.0]), (4, [1.0]), (5, [2.0]), (5, [2.0])]
    assert run(spark, repeated, 20, 1) == brute(repeated, 20, 1, 4)
    large = [(i, [rng, -rng / 3, 7.0]) for i, rng in enumerate([1e7, 1e7, -2e7, 3e6, 5.0, 0.0, 2.0, 9e6])]
    assert run(spark, large, 3, 64) == brute(large, 3, 64, 4)


def test_bounds_drop_most_pairs_and_no_winner():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 60, (32, 16))
    v = np.rint(np.repeat(centres, 20, axis=1) + rng.normal(0, 4, (32, 320))).astype(np.int64)
    q = v[:, ::40]
    same = np.zeros((q.shape[1], v.shape[1]), bool)
    row, col, score = topk.survivors(q, v, same, np.full(q.shape[1], -np.inf), 20)
    scores = q.T @ v
    assert (scores[row, col] == score).all() and len(row) < 0.3 * scores.size
    for i in range(len(scores)):
        assert set(np.flatnonzero(scores[i] > np.sort(scores[i])[-20])) <= set(col[row == i])
    again, _, _ = topk.survivors(q, v, same, np.sort(scores, axis=1)[:, -20].astype(float), 20)
    assert len(again) <= len(row)


def test_other_columns_are_not_read(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], "x", 7, None) for i in range(9)], f"{SCHEMA}, x string, block int, score string")
    scratch = Scratch(spark, "test")
    out = topk.search(scratch.table(vectors.integers(df, 64, "vec_id", "embedding"), "vectors"), F.pmod("vec_id", F.lit(4)) == 0, scratch, 2)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((r.query_id, r.rank, r.vec_id) for r in out.collect()) == [(0, 1, 1), (0, 2, 2), (4, 1, 8), (4, 2, 7), (8, 1, 7), (8, 2, 6)]
