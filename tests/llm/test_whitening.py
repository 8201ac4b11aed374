"""Whitening against numpy on the whole table."""

import math

import numpy as np
import pytest

from chartlake.llm import whitening
from chartlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n string, x int, key string, weight string"


def table(spark, rows):
    return spark.createDataFrame([(k, v, "clash", 1, "clash", "clash") for k, v in rows], SCHEMA).repartition(3)


def plain(rows, weighted=False):
    """{id: [whitened ...]}, n, deviations, eigenvalues, explained."""
    good = [(k, [math.floor(256 * c) for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in good}) if not weighted else sorted(tuple(x) for _, x in good)
    n, fit = len(distinct), np.array(distinct, float)
    sums = [sum(x[d] for x in distinct) for d in range(len(distinct[0]))]
    mean = fit.mean(axis=0)
    values, axes = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = {k: (np.array(x) - mean) @ axes[:, :4] / np.sqrt(np.maximum(values[:4], 1e-300)) for k, x in good}
    deviation = {k: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for k, x in good}
    return white, n, deviation, values[:4] / values.sum()


def check(result, rows, weighted=False):
    white, n, deviation, explained = plain(rows, weighted)
    assert len(result) == 4 * sum(v is not None and all(c is not None and math.isfinite(c) for c in v) for _, v in rows)
    sign = {}
    for r in result:
        c = r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]] and 0 <= r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        expected = white[r["vec_id"]][c]
        if abs(expected) > 1e-3:
            assert sign.setdefault(c, np.sign(expected * r["whitened"])) == np.sign(expected * r["whitened"])
        assert abs(r["whitened"]) == pytest.approx(abs(expected), abs=1e-7)


def sample():
    rng = np.random.default_rng(3)
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(rng.normal(size=(300, 7)) * np.array([5, 4, 3, 2, 1, 0.5, 0.1]))]
    rows += [(1000 + k, rows[0][1]) for k in range(200)] + [(5, rows[5][1])]
    return rows + [(2000, None), (2001, [1.0, None] * 3 + [0.0]), (2002, [math.nan] * 7), (2003, [math.inf] + [0.0] * 6), (2004, [-0.0] * 7)]


def test_matches_numpy(spark):
    check(whitening.whitened(table(spark, sample())).collect(), sample())


def test_weights_by_copies(spark):
    check(whitening.whitened(table(spark, sample()), by_copies=True).collect(), sample(), weighted=True)


def test_tables_without_variance(spark):
    rows = whitening.whitened(table(spark, [(k, [1.0, 2.0, 3.0]) for k in range(5)])).collect()
    assert len(rows) == 15 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] == 0 and r["identity_error"] is None for r in rows)
    line = whitening.whitened(table(spark, [(k, [float(k), 2.0 * k]) for k in range(5)] + [(None, [1.0, 1.5])])).collect()
    assert len(line) == 12 and all(r["identity_error"] < 1e-9 for r in line)
    flat = whitening.whitened(table(spark, [(k, [float(k), 2.0 * k]) for k in range(5)])).collect()
    assert [r["whitened"] for r in flat if r["component"] == 2] == [None] * 5


def test_odd_tables(spark):
    empty = whitening.whitened(table(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened(table(spark, [(1, None), (2, []), (3, [math.nan])])).count() == 0
    # Another width goes; entries beyond a long end at its limits, and a deviation beyond a long is null.
    mixed = whitening.whitened(table(spark, [(1, [1.0]), (2, [1e300, 0.0]), (3, [-1e300, 1.0]), (4, [0.0, 2.0])])).collect()
    assert {r["vec_id"] for r in mixed} == {2, 3, 4} and all(math.isfinite(r["whitened"]) for r in mixed if r["component"] == 1)
    assert all(r["deviation"] is None for r in mixed if r["vec_id"] == 2)


def test_deviations_near_the_limit_of_a_long():
    x = np.array([[2**31, 5], [3_037_000_499, 0], [3_037_000_500, 0], [-(2**63), 2**63 - 1], [2**40, 1]], np.int64)
    for n, sums in ((1, [0, 0]), (3, [7, -9]), (10**10, [10**25, -(10**22)])):
        expected = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
        assert whitening.deviations(x, n, sums) == [v if v < 2**63 else None for v in expected]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op11_embedding_whitening"](spark, sf).collect(), rows)
