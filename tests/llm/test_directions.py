"""Neighbours of one direction, and of any size."""

import math
import random
from collections import defaultdict

import numpy as np

from catalyne.llm import ann


def lists(df, **how):
    got = defaultdict(list)
    for r in ann.nearest(df, df.where("vec_id % 50 = 0"), **how).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    return got


def test_multiples_of_a_vector_tie(spark):
    """More of them than a beam holds, in some shards, among others that are near: the smallest ids are given."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=24)
    rows = [(i, (base * rng.uniform(0.001, 1000)).tolist()) for i in range(400)]
    rows += [(1000 + i, (base + rng.normal(size=24) * 0.01).tolist()) for i in range(400)]
    rows += [(3000 + i, rng.normal(size=24).tolist()) for i in range(600)]
    random.Random(1).shuffle(rows)
    got = lists(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=300, beam=64)
    for q in range(0, 400, 50):
        assert [v for v, _ in got[q]] == [v for v in range(6) if v != q][:5]
        assert all(abs(s - 1) < 1e-12 for _, s in got[q])
    by_id = dict(rows)
    near = [v for v, _ in got[1000]]
    assert len(set(near)) == 5 and all(v < 400 or 1000 <= v < 1400 for v in near)
    for q, found in got.items():
        for v, s in found:
            x, y = np.array(by_id[q]), np.array(by_id[v])
            assert abs(s - x @ y / math.sqrt((x @ x) * (y @ y))) < 1e-12


def test_sizes_that_squares_can_not_hold(spark):
    rng = np.random.default_rng(5)
    plain = {i: rng.normal(size=8) for i in range(120)}
    size = lambda i: [1.0, 1e200, 1e-200, 1e300, 1e-300][i % 5]
    odd = lists(spark.createDataFrame([(i, (x * size(i // 10)).tolist()) for i, x in plain.items()], "vec_id long, embedding array<double>"))
    usual = lists(spark.createDataFrame([(i, x.tolist()) for i, x in plain.items()], "vec_id long, embedding array<double>"))
    assert set(odd) == set(usual) == {0, 50, 100}
    for q, found in usual.items():
        assert [v for v, _ in odd[q]] == [v for v, _ in found]
        assert np.allclose([s for _, s in odd[q]], [s for _, s in found], atol=1e-12)


def test_lengths_and_repeats(spark):
    """Vectors of other lengths have shards without them; a row twice counts once, opposite vectors don't collapse."""
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [-2.0, -0.0]), (2, [3.0, 1e-300]), (3, [5e-324, 0.0]), (4, [1.0, 0.0, 0.0]), (50, [0.0, 2.0, 0.0]), (51, [7.0])]
    got = lists(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=2)
    assert got == {0: [(2, 1.0), (3, 1.0), (1, -1.0)], 50: [(4, 0.0)]}
