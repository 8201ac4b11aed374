"""Table readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.functions.features import year_month_key


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; the types come from one extra pass over the file."""
    return spark.read.csv(path, header=True, inferSchema=True)


def scan_csv_schema(
    spark: SparkSession, path: str, schema: T.StructType | str, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("dateFormat", date_format).csv(path)


def scan_hive_partitioned(spark: SparkSession, path: str, levels: int = 2) -> DataFrame:
    """A year=/month= layout. Level 0 is unpartitioned; 1 has month as an ordinary column."""
    df = spark.read.parquet(path)
    if levels == 0:
        return df
    df = df.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int"))
    return df.withColumn("year_month", year_month_key())


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """The same frame; raises if it has no row. Reads one row, not all of them."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


# Column types of the source tables.
SOURCE_SCHEMAS: Mapping[str, str] = {
    "songs": (
        "track_uri STRING NOT NULL, track_name STRING, artist_names STRING, artist_uris STRING, "
        "label STRING, release_date DATE, all_uris STRING"
    ),
    "artists": "artist_uri STRING NOT NULL, artist_name STRING",
    "albums": (
        "album_uri STRING NOT NULL, album_name STRING, artist_names STRING, artist_uris STRING, "
        "label STRING, release_date DATE"
    ),
    "artwork": "uri STRING NOT NULL, type STRING, image_url STRING, last_seen_date DATE",
    "links": (
        "spotify_uri STRING NOT NULL, type STRING, youtube_music_id STRING, youtube_video_id STRING, "
        "youtube_browse_id STRING, youtube_channel_id STRING"
    ),
    "charts_songs_daily": (
        "date DATE, country STRING, rank INT, uri STRING NOT NULL, artist_names STRING, track_name STRING, "
        "label STRING, peak_rank INT, previous_rank INT, days_on_chart INT, consecutive_days INT, streams BIGINT, "
        "entry_status STRING, peak_date DATE, entry_rank INT, entry_date DATE, release_date DATE, artist_uris STRING"
    ),
    "charts_artists_daily": (
        "date DATE, country STRING, rank INT, uri STRING NOT NULL, artist_name STRING, peak_rank INT, "
        "previous_rank INT, days_on_chart INT, consecutive_days INT, entry_status STRING, peak_date DATE, "
        "entry_rank INT, entry_date DATE"
    ),
    "charts_albums_weekly": (
        "date DATE, country STRING, rank INT, uri STRING NOT NULL, album_name STRING, artist_names STRING, "
        "label STRING, peak_rank INT, previous_rank INT, weeks_on_chart INT, consecutive_weeks INT, "
        "entry_status STRING, peak_date DATE, entry_rank INT, entry_date DATE, release_date DATE, artist_uris STRING"
    ),
}
