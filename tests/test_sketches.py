"""Stored sketches against exact counts and quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlake.operators import sketches as S


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    n = 30_000
    rows = [(int(y), int(m), int(u), float(v)) for y, m, u, v in zip(rng.integers(2000, 2003, n), rng.integers(1, 4, n), rng.zipf(1.3, n) % 9000, rng.normal(size=n))]
    # A third of all rows hold one value.
    rows += [(2001, 2, 7, 0.5)] * (n // 2) + [(2002, 3, None, None)] * 5 + [(2009, 1, None, None)]
    df = spark.createDataFrame(rows, "year int, month int, u long, v double").repartition(6)
    path = str(tmp_path_factory.mktemp("sketches") / "months")
    S.sketches(df, ["year", "month"], {"u": F.col("u")}, {"v": F.col("v")}).write.parquet(path)
    return rows, spark.read.parquet(path)


def test_levels(stored):
    rows, months = stored
    found = S.levels(months, ["u"], ["v"]).select(
        "level", "year", "month", "n", S.distinct_of("u").alias("u"), *[S.quantile_of("v", p).alias(f"p{k}") for k, p in enumerate((0.1, 0.5, 0.9))]
    ).collect()
    assert len(found) == 10 + 4 + 1
    for r in found:
        own = [x for x in rows if (r["year"] is None or x[0] == r["year"]) and (r["month"] is None or x[1] == r["month"])]
        exact = len({x[2] for x in own} - {None})
        assert r["n"] == len(own) and abs(r["u"] - exact) <= S.distinct_error() * exact
        values = np.sort([x[3] for x in own if x[3] is not None])
        for k, p in enumerate((0.1, 0.5, 0.9)):
            if not len(values):
                assert r[f"p{k}"] is None
                continue
            low, high = (np.searchsorted(values, r[f"p{k}"], side) / len(values) for side in ("left", "right"))
            assert low - S.rank_error() <= p <= high + S.rank_error()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "year int, month int, u long, v double")
    months = S.sketches(empty, ["year", "month"], {"u": F.col("u")}, {"v": F.col("v")})
    assert months.count() == 0 and S.merged(months, ["year"], ["u"], ["v"]).count() == 0
