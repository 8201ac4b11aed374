"""Ordered and windowed operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlake.functions.features import percent, percent_or_zero


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int = 1, rank: str | None = None
) -> DataFrame:
    """The first k rows of each group. Spark keeps k rows per map task before the shuffle."""
    col = rank or "_rn"
    out = df.withColumn(col, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(col) <= k)
    return out if rank else out.drop(col)


def add_growth(
    df: DataFrame,
    entity: Sequence[str],
    measure: str = "total_streams",
    out: str = "growth_percentage",
    fill: float | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Percent change against the entity's previous present month.

    The first month, or a previous total of 0, gives NULL (or the fill value). With calendar=True the
    previous row must be the month before, so a gap gives NULL too.
    """
    window = Window.partitionBy(*entity).orderBy("year", "month")
    previous = F.lag(measure).over(window)
    if calendar:
        index = F.col("year") * 12 + F.col("month")
        previous = F.when(F.lag(index).over(window) == index - 1, previous)
    df = df.withColumn("_previous", previous)
    growth = percent(F.col(measure) - F.col("_previous"), F.col("_previous"))
    return df.withColumn(out, growth if fill is None else F.coalesce(growth, F.lit(fill))).drop("_previous")


def share_of_total(
    df: DataFrame,
    group: Sequence[str],
    measure: str = "total_streams",
    out: str = "market_share",
    totals: DataFrame | None = None,
    guarded: bool = False,
) -> DataFrame:
    """Percent of the group's total.

    The total is a small aggregate joined back, not a window: a window would bring all entities of a
    month into one task. The join side is left to the optimiser, which checks its size. Totals (group, _total)
    from a cheaper source than the frame itself save working the frame out twice.
    """
    if totals is None:
        totals = df.groupBy(*group).agg(F.sum(measure).alias("_total"))
    share = percent_or_zero if guarded else percent
    return df.join(totals, list(group), "left").withColumn(out, share(F.col(measure), F.col("_total"))).drop("_total")


def sort_topk(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k rows overall; each task keeps k rows, the driver merges them."""
    return df.orderBy(*order).limit(k)


def distinct_on_best(df: DataFrame, name: str, key: str, measure: str, min_length: int = 5) -> DataFrame:
    """Per name, the key with the largest total (ties: the smaller key). Short names are left out."""
    totals = (
        df.filter(F.col(name).isNotNull() & (F.length(name) >= min_length))
        .groupBy(name, key)
        .agg(F.sum(measure).alias("_total"))
    )
    best = F.min(F.struct((-F.col("_total")).alias("t"), F.col(key).alias("k")))["k"]
    return totals.groupBy(name).agg(best.alias(key))


def latest_periods(df: DataFrame, n: int = 2) -> DataFrame:
    """The newest n months present."""
    return df.select("year", "month").distinct().orderBy(F.desc("year"), F.desc("month")).limit(n)
