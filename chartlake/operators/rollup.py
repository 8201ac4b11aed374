"""Group totals and distinct counts over several entities in one pass.

A table such as "songs, hits, artists and labels per country and month, with the top song and the top
artist" is usually one aggregate per entity, joined back together. Here every fact row is tagged once
per entity it belongs to, the tagged rows are summed per (group, entity), and those sums are folded per
group: two hash shuffles in all, no join, and a hot group or entity is combined on the map side first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.functions.features import is_hit


def entity(key: Column, name: Column | None = None) -> Column:
    """One entity of the row; a NULL key means none."""
    return F.struct(key.alias("key"), (F.lit(None).cast("string") if name is None else name).alias("name"))


def one(key: Column) -> Column:
    return F.array(entity(key))


def many(array: Column, key=lambda x: x, name=lambda x: F.lit(None).cast("string")) -> Column:
    return F.transform(array, lambda x: entity(key(x), name(x)))


def _tagged(kind: str, values: Column) -> Column:
    none = F.array().cast("array<struct<key:string,name:string>>")
    return F.transform(
        F.coalesce(values, none),
        lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("key"), e["name"].alias("name")),
    )


def entity_totals(df: DataFrame, group: Sequence[str], grains: Mapping[str, Column]) -> DataFrame:
    """Streams, hit flag, score and row count per group and entity of each grain."""
    tagged = F.flatten(F.array(*(_tagged(kind, values) for kind, values in grains.items())))
    rows = df.select(
        *group,
        "streams",
        is_hit().cast("int").alias("_hit"),
        score_cents().alias("_cents"),
        F.inline(tagged),
    ).filter("key is not null")
    return rows.groupBy(*group, "kind", "key", "name").agg(
        F.sum("streams").alias("streams"),
        F.max("_hit").alias("hit"),
        F.sum("_cents").alias("cents"),
        F.count(F.lit(1)).alias("n"),
    )


def fold_totals(totals: DataFrame, group: Sequence[str]) -> DataFrame:
    """entity_totals of a finer grouping, added up to fewer columns."""
    return totals.groupBy(*group, "kind", "key", "name").agg(
        F.sum("streams").alias("streams"), F.max("hit").alias("hit"), F.sum("cents").alias("cents"), F.sum("n").alias("n")
    )


def score_cents(score: str = "chart_strength_score") -> Column:
    """The two-digit score as a whole number of hundredths, so that its sum does not depend on row order."""
    return F.round(F.col(score) * 100).cast("long")


def mean_score(cents: Column, n: Column) -> Column:
    return F.round(F.try_divide(cents, n) / 100, 2)


def of(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def n_of(kind: str) -> Column:
    """Entities of the kind; the grain must have no name part."""
    return F.count(of(kind, F.lit(1)))


def hits_of(kind: str) -> Column:
    return F.count(F.when((F.col("kind") == kind) & (F.col("hit") == 1), 1))


def streams_of(kind: str) -> Column:
    return F.sum(of(kind, F.col("streams")))


def score_of(kind: str) -> Column:
    return mean_score(F.sum(of(kind, F.col("cents"))), F.sum(of(kind, F.col("n"))))


def top_of(kind: str, label: str = "key") -> Column:
    """The label with the most streams; ties go to the smaller label."""
    best = F.min(of(kind, F.struct((-F.col("streams")).alias("s"), F.col(label).alias("label"))))
    return best["label"]


def or_null(count: Column) -> Column:
    """A count as a left join would give it: NULL where nothing matched."""
    return F.nullif(count, F.lit(0).cast("long"))
