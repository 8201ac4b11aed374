"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the stated order.

    Spark limits each map task to one row per key before the shuffle, so a hot key costs
    no more than any other.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedupe_business_key(
    df: DataFrame, key: Sequence[str] = ("date", "country", "uri"), largest: str = "streams"
) -> DataFrame:
    """One row per business key: the largest measure, then the smallest other values, so no tie is left open."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in (*key, largest)]
    return keep_first(df, key, [F.col(largest).desc_nulls_last(), *rest])


def dedupe_full_row(df: DataFrame) -> DataFrame:
    return df.distinct()
