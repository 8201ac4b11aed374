"""Profiling and validation as tidy tables: every check of a table runs in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.functions import clean
from chartlake.operators.aggregate import tidy


def _rows() -> Column:
    return F.count(F.lit(1))


def _of(name: str, metrics: Mapping[str, Mapping[str, Column]]) -> list[tuple[dict[str, str], Column]]:
    return [
        ({"table_name": name, "column_name": c, "metric": m}, agg) for c, ms in metrics.items() for m, agg in ms.items()
    ]


def profile_shape(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, and how many columns hold numbers or text."""
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema)
    text = sum(isinstance(f.dataType, T.StringType) for f in df.schema)
    # A literal does not aggregate by itself, so it rides on max.
    fixed = {"columns": len(df.columns), "numeric_columns": numeric, "text_columns": text}
    return tidy(df, _of(name, {"*": {"rows": _rows(), **{k: F.max(F.lit(v)) for k, v in fixed.items()}}}))


def profile_types(df: DataFrame, name: str) -> DataFrame:
    """Type, rows and values present per column."""
    columns = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(f"_n{i}").alias("present")) for i, (c, t) in enumerate(df.dtypes))
    )
    counts = df.agg(_rows().alias("rows"), *(F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)))
    return counts.select(F.lit(name).alias("table_name"), "rows", F.inline(columns))


def profile_nulls(df: DataFrame, name: str) -> DataFrame:
    """NULLs per column, with the percentage of rows."""
    metrics = {}
    for c in df.columns:
        nulls = F.count_if(F.col(c).isNull())
        metrics[c] = {"nulls": nulls, "null_percent": F.round(F.try_divide(nulls, _rows()) * 100, 2)}
    return tidy(df, _of(name, metrics))


def profile_missing_tokens(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    return tidy(df, _of(name, {c: {"missing": F.count_if(clean.is_missing_token(c))} for c in columns}))


def profile_distinct(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column.

    Every (column, value) pair becomes a row and pairs are made distinct by a shuffle on the value itself,
    so neither the width of the table nor one frequent value gathers rows in a task.
    """
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns))
    counts = (
        df.select(F.inline(pairs)).filter("v is not null").distinct().groupBy("column_name").agg(_rows().alias("value"))
    )
    return counts.select(
        F.lit(name).alias("table_name"), "column_name", F.lit("distinct").alias("metric"), F.col("value").cast("double").alias("value")
    )


def profile_duplicates(df: DataFrame, name: str, key: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows (or keys), and the surplus, absolute and in percent."""
    groups = df.groupBy(*(key or df.columns)).agg(_rows().alias("n"))
    total, distinct = F.sum("n"), _rows()
    metrics = {
        "rows": total, "distinct": distinct, "duplicates": total - distinct,
        "duplicate_percent": F.round(F.try_divide(total - distinct, total) * 100, 4),
    }
    return tidy(groups, _of(name, {",".join(key) if key else "*": metrics}))


def profile_range(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value, as text, so that dates and numbers share a column."""
    aggs = [f(c).cast("string").alias(f"{m}_{c}") for c in columns for m, f in (("min", F.min), ("max", F.max))]
    rows = [
        F.struct(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
            F.col(f"min_{c}").alias("min_value"), F.col(f"max_{c}").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def count_violations(df: DataFrame, name: str, rules: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Rows that break each rule; (column, rule name) -> condition that is true for a bad row."""
    return tidy(df, [({"table_name": name, "column_name": c, "metric": m}, F.count_if(bad)) for (c, m), bad in rules.items()])


def domain_rules(
    ranks: Sequence[str] = ("rank", "peak_rank"), positive: Sequence[str] = ("streams", "days_on_chart", "consecutive_days")
) -> dict[tuple[str, str], Column]:
    outside = {(c, "outside 1-200"): ~F.col(c).between(1, 200) for c in ranks}
    return {**outside, **{(c, "not positive"): F.col(c) <= 0 for c in positive}}


def date_parse_rules(columns: Sequence[str], pattern: str = "yyyy-MM-dd") -> dict[tuple[str, str], Column]:
    return {(c, "unparsable date"): F.col(c).isNotNull() & clean.parse_date(c, pattern).isNull() for c in columns}


def date_order_rules(df: DataFrame) -> dict[tuple[str, str], Column]:
    """Dates that come in the wrong order, for whichever date columns the table has."""
    pairs = (("release_date", "date"), ("entry_date", "peak_date"), ("entry_date", "date"), ("release_date", "entry_date"))
    return {
        (a, f"after {b}"): F.col(a) > F.col(b) for a, b in pairs if a in df.columns and b in df.columns
    }


def late_release_by_track(df: DataFrame) -> DataFrame:
    """Tracks charted before their release: rows affected and the largest lead in days."""
    return (
        df.filter(F.col("release_date") > F.col("date"))
        .groupBy("uri")
        .agg(_rows().alias("n"), F.max(F.datediff("release_date", "date")).alias("max_days_early"))
    )


def consistency_rules(status: str | None = None) -> dict[tuple[str, str], Column]:
    """Consecutive days above total days; entry status against the rank movement."""
    rules = {("consecutive_days", "above days_on_chart"): F.col("consecutive_days") > F.col("days_on_chart")}
    if status:
        move = F.col("previous_rank") - F.col("rank")
        rules |= {
            (status, "SAME_POSITION moved"): (F.col(status) == "SAME_POSITION") & (move != 0),
            (status, "MOVE_UP not up"): (F.col(status) == "MOVE_UP") & (move <= 0),
            (status, "MOVE_DOWN not down"): (F.col(status) == "MOVE_DOWN") & (move >= 0),
        }
    return rules


def format_rules(
    uri_prefix: str = "spotify:track:", artist_part: str = "spotify:artist:", code: str = "country", code_length: int = 2
) -> dict[tuple[str, str], Column]:
    return {
        ("uri", f"not prefixed {uri_prefix}"): ~F.col("uri").startswith(uri_prefix),
        ("artist_uris", f"without {artist_part}"): ~F.col("artist_uris").contains(artist_part),
        (code, f"length not {code_length}"): F.length(code) != code_length,
    }


def length_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.length(column).alias("length")).agg(_rows().alias("n"))


def whitespace_rules(columns: Sequence[str]) -> dict[tuple[str, str], Column]:
    rules = {(c, "untrimmed"): F.col(c) != F.trim(c) for c in columns}
    return {**rules, **{(c, "blank"): clean.is_blank(c) for c in columns}}


def case_variants(df: DataFrame, column: str) -> DataFrame:
    """Values spelt in more than one way once case and outer blanks are ignored."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.lower(F.trim(column)).alias("folded"))
        .agg(F.countDistinct(column).alias("spellings"), _rows().alias("n"))
        .filter("spellings > 1")
    )


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once in a column that should be unique."""
    return df.groupBy(F.col(column).alias("value")).agg(_rows().alias("n")).filter("n > 1")


def coverage_between(sides: Mapping[str, tuple[DataFrame, DataFrame]], key: str = "key") -> DataFrame:
    """Distinct keys of each side and how many the other side lacks; kind -> (chart, metadata).

    Both directions come from one grouping of the two key sets by key.
    """
    out = None
    for kind, (chart, listed) in sides.items():
        marked = chart.select(key, F.lit(1).alias("c"), F.lit(0).alias("m")).unionByName(
            listed.select(key, F.lit(0).alias("c"), F.lit(1).alias("m"))
        )
        flags = marked.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("c").alias("c"), F.max("m").alias("m"))
        row = flags.agg(
            F.lit(kind).alias("kind"),
            F.count_if(F.col("c") == 1).alias("in_chart"),
            F.count_if(F.col("m") == 1).alias("in_metadata"),
            F.count_if((F.col("c") == 1) & (F.col("m") == 0)).alias("chart_without_metadata"),
            F.count_if((F.col("c") == 0) & (F.col("m") == 1)).alias("metadata_without_chart"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def missing_by_group(df: DataFrame, missing: Column, group: str, key: str) -> DataFrame:
    """Bad rows and distinct keys affected, per group."""
    return (
        df.filter(missing).groupBy(group, key).agg(_rows().alias("n"))
        .groupBy(group).agg(F.sum("n").alias("n"), _rows().alias("keys_affected"))
    )


def category_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, distinct tracks and streams per value of each category column, in one pass over the table."""
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns))
    return (
        df.select("uri", "streams", F.inline(pairs))
        .groupBy("feature", "category", "uri")
        .agg(_rows().alias("n"), F.sum("streams").alias("s"))
        .groupBy("feature", "category")
        .agg(F.sum("n").alias("n"), _rows().alias("tracks"), F.sum("s").alias("total_streams"))
    )
