"""Yearly rollups of the monthly tables, rendered as text chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean(col: str) -> Column:
    """Mean of a two-digit column, summed as hundredths so that it does not depend on row order."""
    cents = F.round(F.col(col) * 100).cast("long")
    return F.round(F.try_divide(F.sum(cents), F.count(cents)) / 100, 6)


def _latest(col: str) -> Column:
    """The latest month's value, NULLs skipped."""
    return F.max(F.when(F.col(col).isNotNull(), F.struct("month", col)))[col]


def country_year(country_performance: DataFrame) -> DataFrame:
    return country_performance.groupBy("country_name", "year").agg(
        F.sum("total_streams").alias("total_streams"),
        F.max("active_songs").alias("active_songs"),
        F.max("hit_songs").alias("hit_songs"),
        _mean("avg_chart_strength").alias("avg_chart_strength"),
        F.max("active_artists").alias("active_artists"),
        _mean("growth_percentage").alias("growth_percentage"),
        _latest("top_song_name").alias("top_song_name"),
        _latest("top_artist_name").alias("top_artist_name"),
    )


def label_year(label_performance: DataFrame) -> DataFrame:
    """Over all countries, too."""
    return label_performance.groupBy("standardized_label", "year").agg(
        F.sum("total_streams").alias("total_streams"),
        F.max("active_songs").alias("active_songs"),
        F.max("active_artists").alias("active_artists"),
    )


def song_year(kpi_song: DataFrame, track_catalog: DataFrame) -> DataFrame:
    """The label is the smallest of the track's labels."""
    yearly = kpi_song.groupBy("uri", "year").agg(
        F.min("standardized_label").alias("standardized_label"),
        F.sum("total_streams").alias("total_streams"),
        F.max("is_hit").alias("is_hit"),
    )
    return yearly.join(track_catalog, "uri", "left")


def artist_year(artist_performance: DataFrame) -> DataFrame:
    """Track counts are summed over countries and months, so a track counts once in each."""
    return artist_performance.groupBy("artist_uri", "year").agg(
        F.min("artist_name").alias("artist_name"),
        F.sum("total_streams").alias("total_streams"),
        F.sum("track_count").alias("track_count"),
        F.sum("hit_track_count").alias("hit_track_count"),
        F.min("best_rank").alias("best_rank"),
    )


# One sentence per yearly row of each table.
COUNTRY_SENTENCE = (
    "In %s during %d, Spotify recorded %s total streams, with up to %d active song(s) (up to %d of them hits) "
    "and an average chart strength of %s. Up to %d active artists were represented that year, with average growth "
    "of %s%%. Most recent top song was %s, top artist was %s."
)
LABEL_SENTENCE = "Label %s in %d had %s total streams across up to %d active song(s) from up to %d artist(s)."
SONG_SENTENCE = 'Track "%s"%s had %s total streams in %d and %s that year.'
ARTIST_SENTENCE = (
    "In %d, artist %s (%s) had %s total streams across up to %d charting track appearance(s), including %d hit "
    "track appearance(s), reaching a best chart rank of %d that year."
)


def _commas(col: str) -> Column:
    return F.format_number(F.col(col), 0)


def _fixed(col: str) -> Column:
    """Two digits; a missing mean reads nan. Rounded first, so that a tie does not depend on the formatter."""
    return F.when(F.col(col).isNotNull(), F.format_string("%.2f", F.round(col, 2))).otherwise("nan")


def country_text() -> Column:
    return F.format_string(
        COUNTRY_SENTENCE, "country_name", "year", _commas("total_streams"), "active_songs", "hit_songs",
        _fixed("avg_chart_strength"), F.coalesce("active_artists", F.lit(0)), _fixed("growth_percentage"),
        F.coalesce("top_song_name", F.lit("None")), F.coalesce("top_artist_name", F.lit("None")),
    )


def label_text() -> Column:
    return F.format_string(
        LABEL_SENTENCE, "standardized_label", "year", _commas("total_streams"), "active_songs", "active_artists"
    )


def song_text() -> Column:
    """A track without a name goes by its uri; one without a label has none mentioned."""
    label = F.when(F.col("standardized_label") != "", F.concat(F.lit(" on label "), F.col("standardized_label")))
    return F.format_string(
        SONG_SENTENCE, F.coalesce("track_name", "uri"), F.coalesce(label, F.lit("")), _commas("total_streams"), "year",
        F.when(F.col("is_hit") == 1, "was a hit").otherwise("was not a hit"),
    )


def artist_text() -> Column:
    return F.format_string(
        ARTIST_SENTENCE, "year", "artist_name", "artist_uri", _commas("total_streams"), "track_count",
        "hit_track_count", "best_rank",
    )


def chunks_of(yearly: DataFrame, source_table: str, key: str, text: Column) -> DataFrame:
    return yearly.select(
        F.lit(source_table).alias("source_table"),
        F.concat_ws("|", F.col(key), F.col("year").cast("string")).alias("source_key"),
        text.alias("chunk_text"),
    )


def render_chunks(
    country_performance: DataFrame,
    label_performance: DataFrame,
    kpi_song: DataFrame,
    track_catalog: DataFrame,
    artist_performance: DataFrame,
) -> DataFrame:
    """One sentence per entity and year; the key is entity|year."""
    parts = (
        chunks_of(country_year(country_performance), "country_performance", "country_name", country_text()),
        chunks_of(label_year(label_performance), "label_performance_enhanced", "standardized_label", label_text()),
        chunks_of(song_year(kpi_song, track_catalog), "kpi_song", "uri", song_text()),
        chunks_of(artist_year(artist_performance), "artist_performance", "artist_uri", artist_text()),
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
