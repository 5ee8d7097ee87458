import math
from fractions import Fraction

import numpy as np
import pytest

from roadflux.llm import topk


def brute(rows, k=5):
    good = [(i, [math.floor(256 * Fraction(float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("n,dims,block", [(7, 3, 8192), (400, 40, 64), (300, 5, 100)])
def test_against_brute_force(spark, monkeypatch, n, dims, block):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    rng = np.random.default_rng(n)
    data = rng.normal(size=(n, dims)).astype(np.float32).astype(float)
    data[n // 2:] = data[n // 2]  # a very common vector, so many ties
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(None, rows[0][1]), (10_000, None), (10_001, []), (10_050, [1.0, None]), (10_100, [float("nan")] * dims), (10_150, [float("inf")] * dims),
             (3, rows[3][1]), (10_200, [0.5])]
    frame = spark.createDataFrame([(v, 1, i, "x") for i, v in rows], "embedding array<float>, score int, vec_id long, v string").repartition(3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(frame).collect())
    assert got == brute(rows)


def test_pruning_keeps_exact_scores():
    rng = np.random.default_rng(0)
    c = rng.integers(-300, 300, (2000, 64))
    c[:, 32:] //= 40
    got = topk.best(c[:3], np.array([-1, -2, -3]), c, np.arange(2000), 5)
    for q in range(3):
        s = c @ c[q]
        want = sorted(zip(-s, range(2000)))[:5]
        assert [(i, t) for a, i, t in got if a == q] == [(i, -t) for t, i in want]


def test_empty(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("size", [2 ** 30, 2 ** 31, 2 ** 40, 2 ** 100])
def test_large_components(size):
    """Partial sums beyond 64 bits, small and large candidates side by side, final scores that fit in a long or not."""
    rng = np.random.default_rng(5)
    for trial in range(20):
        def vector(most):
            return [int(x * most) for x in rng.uniform(-1, 1, 32)]

        half = [vector(size) for _ in range(40)]
        rows = [[*h, *(-x for x in h[:31]), h[31] - int(rng.integers(0, 9))] for h in half] + [vector(200) * 2 for _ in range(40)]
        queries = [[1, 2] * 32, [*half[0], *half[0]], [0] * 64]
        make = lambda m: np.array(m, object if size > 2 ** 62 else np.int64)
        got = topk.best(make(queries), np.array([-1, -2, -3]), make(rows), np.arange(80), 5)
        for q in range(3):
            want = sorted((-sum(a * b for a, b in zip(queries[q], r)), i) for i, r in enumerate(rows))[:5]
            assert [(i, s) for a, i, s in got if a == q] == [(i, -s) for s, i in want]


def test_search_with_large_components(spark):
    big = [2.0 ** 33, 2.0 ** 90, 2.0 ** 40, 1e300]
    rows = [(0, [0.5, 0.0, 0.25, 0.0]), *[(i, [float(i) / 7, big[i % 4], -float(i), big[(i + 1) % 4]]) for i in range(1, 40)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(frame).collect())
    assert got == brute(rows)


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        topk.search(spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")).collect()
