import math

import numpy as np
import pytest

from tapework.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in dict((i, v) for i, v in good if i % 100 == 0).items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def search(spark, rows, k=10):
    v = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4))
    return sorted(tuple(r) for r in topk.top_k(v, v.where("vec_id % 100 = 0"), k).collect())


def vectors(n, width=16, seed=0):
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, width)) * random.gamma(1, 1, (n, 1)) * (0.7 ** np.arange(width))
    return [(k, [float(x) for x in v], "x") for k, v in enumerate(base)]


@pytest.mark.parametrize("sizes", [(2_048, 4_096), (16, 3)])
def test_top_k_is_that_of_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "BLOCK_ROWS", sizes[0])
    monkeypatch.setattr(topk, "QUERIES_PER_ROUND", sizes[1])
    rows = vectors(700)
    assert search(spark, rows) == brute(rows, 10)


def test_ties_repeats_and_bad_vectors(spark):
    rows = [(k, [1.0, 0.5], "x") for k in range(30)] + [(100, [0.0, 0.0], None), (200, [-1.0, 2.0], "y")]
    bad = [(300, None, "x"), (400, [float("nan"), 1.0], "x"), (500, [None, 1.0], "x"), (None, [9.0, 9.0], "x"), (7, [float("inf"), 0.0], "x")]
    assert search(spark, rows + bad) == brute(rows, 10)
    assert search(spark, [*rows, rows[5]])[0][0] == 0


def test_few_rows_short_vectors_and_large_values(spark):
    rows = [(0, [1e6, 1.0, -8e5], "x"), (1, [7e5, 5.0, 3e5], "x"), (100, [-1e6, 2.0, 9e5], "x")]  # beyond 2 ** 53
    assert search(spark, rows) == brute(rows, 10)
    got = search(spark, [(0, [1.0], "x"), (1, [2.0, 7.0], "x"), (2, [], "x")])
    assert got == [(0, 1, 1, 2 * 1024 * 1024), (0, 2, 2, 0)]
    assert search(spark, []) == search(spark, [(1, [1.0], "x")]) == []
