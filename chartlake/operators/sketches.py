"""Sketches of distinct values and of quantiles, kept as columns per month and merged without the facts.

A HyperLogLog sketch of 2**lg registers misses the number of distinct values by a standard error of about 1.04 / sqrt(2**lg). A KLL
sketch of size k answers quantiles within a rank error of about 2.3 / k**0.9 (for one quantile, at 99 %). Both merge: the sketch
of a union is the union of the sketches, so months written once add up to years, totals, or any later period.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 14
KLL_SIZE = 400


def distinct_error(lg: int = LG, spreads: float = 3.0) -> float:
    """The relative error that holds but for about one case in 400 at three standard errors."""
    return spreads * 1.04 / 2 ** (lg / 2)


def rank_error(size: int = KLL_SIZE) -> float:
    return 2.296 / size**0.9021


def sketches(
    df: DataFrame, by: Sequence[str], distinct: Mapping[str, Column] | None = None, quantiles: Mapping[str, Column] | None = None,
    lg: int = LG, size: int = KLL_SIZE,
) -> DataFrame:
    """One row per group: its rows n, and a sketch column for each name. Nulls add nothing; a group of nulls has empty sketches.

    Each task sketches its own rows, so what is shuffled is a sketch per task and group, however many rows a group has.
    """
    hll = {name: F.hll_sketch_agg(c, F.lit(lg)) for name, c in (distinct or {}).items()}
    kll = {name: F.kll_sketch_agg_double(c.cast("double"), F.lit(size)) for name, c in (quantiles or {}).items()}
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in {**hll, **kll}.items()])


def merged(stored: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = ()) -> DataFrame:
    """Stored sketches merged to coarser groups; none given: to one row."""
    hll = [F.hll_union_agg(name).alias(name) for name in distinct]
    kll = [F.kll_merge_agg_double(name).alias(name) for name in quantiles]
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), *hll, *kll)


def distinct_of(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_of(sketch: str, prob: float) -> Column:
    """Null for a group without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(prob)))


def levels(stored: DataFrame, distinct: Sequence[str] = (), quantiles: Sequence[str] = ()) -> DataFrame:
    """(level, year, month, n, sketches) of stored months: each month, each year and the whole, all from the same rows."""
    none = F.lit(None).cast("int")
    names = [*distinct, *quantiles]
    parts = [
        stored.select(F.lit("month").alias("level"), "year", "month", "n", *names),
        merged(stored, ["year"], distinct, quantiles).select(F.lit("year").alias("level"), "year", none.alias("month"), "n", *names),
        merged(stored, [], distinct, quantiles).select(F.lit("all").alias("level"), none.alias("year"), none.alias("month"), "n", *names),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
