"""Nearest neighbours of vectors whose squares leave a double's range."""

import math

import numpy as np

from chartlake.llm import projections

SCHEMA = "vec_id long, embedding array<double>"


def search(spark, rows, k=3):
    df = spark.createDataFrame(rows, SCHEMA)
    out = {}
    for r in projections.nearest_neighbours(df, df, k).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_order_is_that_of_small_vectors(spark):
    rng = np.random.default_rng(2)
    small = rng.normal(size=(60, 5))
    plain = search(spark, [(k, v.tolist()) for k, v in enumerate(small)])
    large = search(spark, [(k, np.ldexp(v, 700).tolist()) for k, v in enumerate(small)])
    assert {q: [i for i, _ in v] for q, v in large.items()} == {q: [i for i, _ in v] for q, v in plain.items()}
    assert all(math.isinf(s) and (s > 0) == (p > 0) for q in plain for (_, s), (_, p) in zip(large[q], plain[q]))


def test_products_within_range_stay_exact(spark):
    got = search(spark, [(1, [1e200, 0.0]), (2, [1e-50, 1e-50]), (3, [3.0, 4.0]), (4, [0.0, 0.0])])
    assert set(got) == {1, 2, 3}
    assert got[1] == [(3, 3e200), (2, 1e150)] and got[3][0] == (1, 3e200)
