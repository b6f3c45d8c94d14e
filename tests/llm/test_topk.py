"""Exact top-k against all pairs."""

import random

import numpy as np
import pytest

from plumbline.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=10, every=100):
    good = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i % every == 0:
            scored = sorted((-int((q * v).sum()), j) for b, (j, v) in enumerate(good) if b != a and len(v) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as label", "2 as dim", "3 as score", "4 as query_id")
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == plain(rows)


def test_ties_repeats_and_many_blocks(spark, monkeypatch):
    pick = random.Random(1)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    rows = [(i, [round(pick.uniform(-1, 1), 1) for _ in range(6)]) for i in range(2500)]
    rows += [(100, rows[100][1]), (100, rows[100][1]), (7, rows[7][1]), (200, [0.5] * 6)] + [(3000 + i, rows[5][1]) for i in range(800)]
    check(spark, rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [9.0, 9.0]), (6, [1.0, 2.0, 3.0]), (100, []), (101, []), (200, [-1.0, 0.0]), (7, [0.0, 0.0])]
    check(spark, rows)
    check(spark, [(1, [1.0])])
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bounds_hold_and_large_numbers_are_exact():
    pick = np.random.default_rng(2)
    a, b = pick.integers(-1000, 1000, (40, 64)), pick.integers(-1000, 1000, (60, 64))
    for left, right in zip(topk.statistics(a), topk.statistics(b), strict=True):
        assert (left @ right.T >= a @ b.T - 1e-3).all()
    big = np.array([[1 << 40, -(1 << 20)]], np.int64)
    assert topk.exact(big, big[:, ::-1].copy(), np.array([0]), np.array([0])).tolist() == [-(1 << 61)]
    with pytest.raises(OverflowError):
        topk.exact(big, big, np.array([0]), np.array([0]))


def test_pruning_skips_most_pairs():
    pick = np.random.default_rng(3)
    near = pick.integers(900, 1000, (20, 64))
    far = np.concatenate([-near, near[:, ::-1] // 10])
    q, _ = topk.survivors(topk.statistics(near[:5]), topk.statistics(far), np.full(5, 40_000_000))
    assert len(q) == 0
