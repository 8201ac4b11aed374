"""Bronze chart facts to cleaned, enriched facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions import arrays, clean, features
from chartlake.operators.dedupe import dedupe_business_key, dedupe_full_row


def clean_chart(
    bronze: DataFrame,
    countries: Mapping[str, str] = K.COUNTRY_NAMES,
    defaults: Mapping[str, str] = K.DEFAULTS,
    drop_rollup: str | None = K.ROLLUP_COUNTRY,
) -> DataFrame:
    """Map the market code, drop the rollup member, dedupe, fill and trim.

    The rollup filter stands before the dedupe: country is part of the key, so the result is the
    same and the dropped rows are never shuffled. Like the comparison it stands for, it also
    drops markets without a name; drop_rollup=None keeps both.
    """
    name = clean.map_lookup("country", countries)
    kept = bronze if drop_rollup is None else bronze.filter(name != drop_rollup)
    once = dedupe_business_key(kept).withColumn("country_name", name).withColumnRenamed("country", "market")
    filled = once.fillna(dict(defaults))
    return filled.withColumns({c: F.trim(c) for c in defaults})


def add_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "hit_category": features.hit_category(),
            "standardized_label": clean.standardize("label"),
            "chart_strength_score": features.chart_strength_raw(),
        }
    )


def silver_chart(bronze: DataFrame, **options) -> DataFrame:
    """The cleaned fact: one row per date, market and track."""
    return add_features(clean_chart(bronze, **options))


def normalize_score(df: DataFrame) -> DataFrame:
    """0 to 100 score, scaled by the table's own maxima.

    The maxima are one row, joined as a broadcast in the same plan instead of a separate job.
    """
    maxima = df.agg(
        F.max("days_on_chart").alias("_max_days"), F.max("consecutive_days").alias("_max_consecutive")
    ).withColumn("_one", F.lit(1))
    score = features.chart_strength_normalized(F.col("_max_days"), F.col("_max_consecutive"))
    return (
        df.withColumn("_one", F.lit(1))
        .join(F.broadcast(maxima), "_one")
        .withColumn("chart_strength_score", score)
        .drop("_one", "_max_days", "_max_consecutive")
    )


def silver_chart_rich(bronze: DataFrame, **options) -> DataFrame:
    """The cleaned fact with release age, movement, tier and normalised score."""
    return normalize_score(
        silver_chart(bronze, **options)
        .withColumns({"week": F.weekofyear("date"), "valid_release_date": features.valid_release_date()})
        .withColumns({"song_age_days": features.song_age_days(), "rank_movement": features.rank_movement()})
        .withColumns(
            {
                "song_age_category": features.song_age_category(),
                "movement_category": features.movement_category_v2(),
                "stream_tier": features.stream_tier(),
            }
        )
    )


def artist_bridge(silver: DataFrame) -> DataFrame:
    """Distinct track, artist and name."""
    bridge = dedupe_full_row(silver.select("uri", F.inline(arrays.credits())))
    return bridge.filter("artist_uri is not null and artist_name is not null").withColumn(
        "standardized_artist_name", clean.standardize("artist_name")
    )
