"""Join shapes. Physical strategy is left to the optimiser, which checks sizes before it broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the left side that the right side lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def lookup_or_key(df: DataFrame, names: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """The name from the lookup, or the key itself where there is none."""
    return df.join(names.select(key, name), key, "left").withColumn(out, F.coalesce(F.col(name), F.col(key)))


def year_change(
    df: DataFrame, entity: Sequence[str], target: int, previous: int, measure: str = "total_streams"
) -> DataFrame:
    """Absolute change of each entity's total between two years, for entities present in the target year.

    One conditional sum per year in a single pass stands for the self-join.
    """
    def total(year: int) -> Column:
        return F.sum(F.when(F.col("year") == year, F.col(measure)))

    # The prune to two years reaches the scan when year is a partition column.
    return (
        df.filter(F.col("year").isin(target, previous))
        .groupBy(*entity)
        .agg(
            total(target).alias("target_total"),
            F.coalesce(total(previous), F.lit(0)).alias("previous_total"),
            F.max(F.col("year") == target).alias("_present"),
        )
        .filter("_present")
        .drop("_present")
        .withColumn("growth", F.col("target_total") - F.col("previous_total"))
    )


def semi_by_list(df: DataFrame, key: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose key is in a short list, or in a table of keys."""
    if isinstance(values, DataFrame):
        return df.join(values, key, "left_semi")
    return df.filter(F.col(key).isin(*values))
