"""Runs on the chart: unbroken stretches of days, and what they say about a track's staying power.

Definitions of our own, all optional: a run is a longest stretch of days on each of which the entity is present, with at most `gap` days
missing between two of them. Longevity is the number of days present, sustainability the share of the days from the first to the last
one that are present, and an entity is evergreen from a run of `evergreen_days` days on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days that one task orders for an entity at a time.
BLOCK_DAYS = 366
EVERGREEN_DAYS = 365


def _islands(rows: DataFrame, within: Sequence[str], first: str, last: str, gap: int, sums: Sequence[Column]) -> DataFrame:
    """Neighbours no more than gap days apart joined to one row, in order of their first day."""
    order = Window.partitionBy(*within).orderBy(first)
    new = F.datediff(F.col(first), F.lag(last).over(order)) > gap + 1
    marked = rows.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int"))
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_island", island).groupBy(*within, "_island").agg(
        F.min(first).alias("_first"), F.max(last).alias("_last"), *sums
    ).drop("_island")


def runs(df: DataFrame, keys: Sequence[str], day: str = "date", gap: int = 0, streams: str = "streams", block_days: int = BLOCK_DAYS) -> DataFrame:
    """(keys, run_start, run_end, days, streams) of every run.

    An entity's days are ordered in blocks of time first, and the runs of its blocks are then joined at the blocks' ends, so an entity with
    a long history or very many rows is never ordered in one task. Rows of one day count once as a day. Rows without a day go.
    """
    keys = list(keys)
    days = df.filter(F.col(day).isNotNull()).groupBy(*keys, F.col(day).cast("date").alias("_day")).agg(F.sum(streams).alias("_streams"))
    blocked = days.withColumn("_block", F.floor(F.unix_date("_day") / block_days))
    parts = _islands(
        blocked, [*keys, "_block"], "_day", "_day", gap, [F.count(F.lit(1)).alias("_days"), F.sum("_streams").alias("_total")]
    ).withColumnsRenamed({"_first": "_from", "_last": "_to"})
    whole = _islands(parts, keys, "_from", "_to", gap, [F.sum("_days").alias("days"), F.sum("_total").alias("streams")])
    return whole.select(*keys, F.col("_first").alias("run_start"), F.col("_last").alias("run_end"), "days", "streams")


def staying_power(found: DataFrame, keys: Sequence[str], evergreen_days: int = EVERGREEN_DAYS) -> DataFrame:
    """One row per entity from its runs: runs, longevity, longest_run, span_days, sustainability, evergreen."""
    span = F.datediff(F.max("run_end"), F.min("run_start")) + 1
    length = F.datediff(F.col("run_end"), F.col("run_start")) + 1
    table = found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), F.sum("days").alias("longevity"), F.max(length).cast("long").alias("longest_run"), span.cast("long").alias("span_days"),
    )
    return table.withColumns({
        "sustainability": F.round(F.col("longevity") / F.col("span_days") * 100, 2), "evergreen": F.col("longest_run") >= evergreen_days,
    })
