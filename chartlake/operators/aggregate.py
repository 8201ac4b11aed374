"""Whole-table statistics in one pass, as tidy rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.session import work_dir


def tidy(df: DataFrame, rows: Sequence[tuple[dict[str, str], Column]], value: str = "value") -> DataFrame:
    """One output row per (labels, aggregate); all aggregates run in a single pass.

    Only the one aggregated row is turned into many.
    """
    slots = [f"_a{i}" for i in range(len(rows))]
    wide = df.agg(*(agg.cast("double").alias(slot) for slot, (_, agg) in zip(slots, rows)))
    structs = [
        F.struct(*(F.lit(v).alias(k) for k, v in labels.items()), F.col(slot).alias(value))
        for slot, (labels, _) in zip(slots, rows)
    ]
    return wide.select(F.inline(F.array(*structs)))


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair, all in one aggregate."""
    rows = [({"x": x, "y": y}, F.corr(x, y)) for x, y in combinations(columns, 2)]
    return tidy(df, rows, "correlation").withColumn("correlation", F.round("correlation", digits))


STATISTICS = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    rows = [({"column_name": c, "metric": m}, f(c)) for c in columns for m, f in STATISTICS.items()]
    return tidy(df, rows).withColumn("value", F.round("value", digits))


def approx_distinct(df: DataFrame, columns: Sequence[str] | None = None, error: float = 0.05) -> DataFrame:
    rows = [({"column_name": c}, F.approx_count_distinct(c, error)) for c in columns or df.columns]
    return tidy(df, rows, "approx_distinct").withColumn("approx_distinct", F.col("approx_distinct").cast("long"))


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), error: float = 0.01
) -> DataFrame:
    rows = [
        ({"column_name": c, "metric": f"p{round(p * 100)}"}, F.percentile_approx(c, p, round(1 / error)))
        for c in columns
        for p in probs
    ]
    return tidy(df, rows)


def exact_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], rows_per_range: int = 1_000_000
) -> DataFrame:
    """Exact interpolated quantiles as rows (prob, value), without bringing the values together.

    The distinct values are counted, cut into value ranges at approximate quantiles, and numbered per range;
    the rows before each range come from the ranges' own totals. Only those few totals meet in one task, and
    a value that repeats any number of times is a single row by then.
    """
    return _quantiles_of_counts(value_counts(df, [column])[column], probs, rows_per_range)


def value_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Each column's distinct values with their counts (v, n), all from one pass over the table and one shuffle.

    Every (column, value) pair becomes a row, summed per task before the shuffle. Written once, as the counts are read several times.
    Whole numbers are kept as such, so that large ones stay exact.
    """
    types = {f.name: f.dataType for f in df.schema if f.name in columns}
    whole = {c: isinstance(t, T.IntegralType) for c, t in types.items()}
    pair = lambda c: F.struct(
        F.lit(c).alias("column_name"), (F.col(c) if whole[c] else F.lit(None)).cast("long").alias("whole"),
        (F.lit(None) if whole[c] else F.col(c)).cast("double").alias("other"),
    )
    pairs = df.select(F.inline(F.array(*map(pair, columns)))).filter("whole is not null or other is not null")
    counted = pairs.groupBy("column_name", "whole", "other").agg(F.count(F.lit(1)).alias("n"))
    path = work_dir(df.sparkSession, "value_counts")
    counted.write.partitionBy("column_name").parquet(path)
    read = df.sparkSession.read.schema(counted.schema).parquet(path)
    return {
        c: read.filter(F.col("column_name") == c).select(F.col("whole" if whole[c] else "other").cast(types[c]).alias("v"), "n") for c in columns
    }


def _quantiles_of_counts(counts: DataFrame, probs: Sequence[float], rows_per_range: int = 1_000_000) -> DataFrame:
    # As many ranges as keep a task's share of the distinct values at rows_per_range; two at least.
    buckets = max(2, -(-counts.count() // rows_per_range))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = counts.agg(F.array_distinct(F.percentile_approx("v", F.array(*map(F.lit, steps)), 10 * buckets)).alias("cuts"))
    # Cut points are at most buckets values in one row.
    cut = counts.withColumn("_one", F.lit(1)).join(F.broadcast(cuts.withColumn("_one", F.lit(1))), "_one")
    binned = cut.select("v", "n", F.size(F.filter("cuts", lambda c: c <= F.col("v"))).alias("bin"))
    totals = binned.groupBy("bin").agg(F.sum("n").alias("n"))
    before = totals.select(
        "bin",
        (F.sum("n").over(Window.orderBy("bin")) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    within = F.sum("n").over(Window.partitionBy("bin").orderBy("v"))
    placed = binned.withColumn("_upto", within).join(F.broadcast(before), "bin").select(
        "v", "total", (F.col("before") + F.col("_upto") - F.col("n")).alias("first"), (F.col("before") + F.col("_upto")).alias("end")
    )
    wanted = F.explode(F.array(*(F.struct(F.lit(float(p)).alias("prob")) for p in probs)))
    # A quantile lies between the rows at floor and ceil of its position; only those values are kept.
    spot = (F.col("total") - 1) * F.col("p.prob")
    hits = placed.withColumn("p", wanted).withColumn("lo", F.floor(spot)).withColumn("hi", F.ceil(spot))
    inside = lambda at: (F.col(at) >= F.col("first")) & (F.col(at) < F.col("end"))
    return (
        hits.filter(inside("lo") | inside("hi"))
        .groupBy(F.col("p.prob").alias("prob"))
        .agg(
            F.max(F.when(inside("lo"), F.col("v"))).alias("low"),
            F.max(F.when(inside("hi"), F.col("v"))).alias("high"),
            F.max(spot - F.col("lo")).alias("part"),
        )
        .select("prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).cast("double").alias("value"))
    )


def exact_quartiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), digits: int = 4) -> DataFrame:
    """Tidy rows (column_name, metric, value) of exact interpolated quantiles of several columns."""
    out = None
    for c, counts in value_counts(df, columns).items():
        rows = _quantiles_of_counts(counts, probs).select(
            F.lit(c).alias("column_name"), F.concat(F.lit("p"), F.round(F.col("prob") * 100).cast("int")).alias("metric"),
            F.round("value", digits).alias("value"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def outlier_iqr(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Quartile fences, with the count and percent of rows outside them."""
    q = exact_quantiles(df, column, (0.25, 0.75))
    fences = q.agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    fences = fences.withColumns({"lower": F.col("q1") - iqr * factor, "upper": F.col("q3") + iqr * factor, "_one": F.lit(1)})
    return (
        df.select(column, F.lit(1).alias("_one"))
        .join(F.broadcast(fences), "_one")
        .groupBy("q1", "q3", "lower", "upper")
        .agg(
            F.count_if(F.col(column) > F.col("upper")).alias("above"),
            F.count_if(F.col(column) < F.col("lower")).alias("below"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("above_percent", F.round(F.col("above") / F.col("n") * 100, 2))
    )
