"""Projection, cleaning, row-level features and multi-valued attributes."""

from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake import fixtures
from chartlake.functions import arrays, clean, features
from chartlake.operators import dedupe
from chartlake.plans import gold as G
from chartlake.plans.catalog.base import (
    COUNTRY_NAME, HIT_CATEGORY, REST, SCORE, bronze, initcap, over_chart, over_rich, over_silver, parts, query, rich, silver,
)

ROW = ("date", "country", "uri", "rank", "streams")
ROW_SQL = ", ".join(ROW)


def over_bronze(name: str, sql: str, build) -> None:
    """Register a row-level query over the raw chart."""
    query(name, over_chart(sql))(lambda spark, sf: build(bronze(spark, sf)))


# --- projection, filter, cleaning ---------------------------------------------------------

over_bronze(
    "project_columns",
    "SELECT streams, uri, country AS market, date FROM chart",
    lambda df: df.select("uri", "country", "date", "rank", "streams")
    .drop("rank")
    .withColumnRenamed("country", "market")
    .select("streams", "uri", "market", "date"),
)
over_bronze(
    "dedupe_business_key",
    f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (
        PARTITION BY date, country, uri ORDER BY streams DESC NULLS LAST, {REST}) AS rn FROM chart) WHERE rn = 1""",
    dedupe.dedupe_business_key,
)
over_bronze(
    "dedupe_full_row",
    "SELECT DISTINCT uri, track_name, label, artist_names, artist_uris FROM chart",
    lambda df: dedupe.dedupe_full_row(df.select("uri", "track_name", "label", "artist_names", "artist_uris")),
)
over_bronze(
    "map_lookup",
    f"SELECT country, {COUNTRY_NAME} AS country_name, count(*) AS n FROM chart GROUP BY ALL",
    lambda df: df.withColumn("country_name", clean.map_lookup("country", fixtures.CHART_COUNTRIES))
    .groupBy("country", "country_name")
    .agg(F.count(F.lit(1)).alias("n")),
)
query(
    "map_lookup_with_default",
    over_silver(
        """SELECT standardized_label, CASE WHEN standardized_label IN ('Brand#1', 'Brand#2') THEN 'Columbia'
        WHEN standardized_label = 'Independent' THEN 'Republic Records' ELSE standardized_label END AS mapped_label,
        count(*) AS n FROM silver GROUP BY ALL"""
    ),
)(
    lambda spark, sf: silver(spark, sf)
    .withColumn(
        "mapped_label",
        clean.map_lookup_with_default(
            "standardized_label", {"Brand#1": "Columbia", "Brand#2": "Columbia"}, {"Independent": "Republic Records"}
        ),
    )
    .groupBy("standardized_label", "mapped_label")
    .agg(F.count(F.lit(1)).alias("n"))
)
over_bronze(
    "drop_rollup_member",
    f"SELECT {ROW_SQL}, {COUNTRY_NAME} AS country_name FROM chart WHERE {COUNTRY_NAME} <> 'Global'",
    lambda df: df.select(*ROW, clean.map_lookup("country", fixtures.CHART_COUNTRIES).alias("country_name")).filter(
        F.col("country_name") != K.ROLLUP_COUNTRY
    ),
)
over_bronze(
    "fill_defaults",
    f"""SELECT {ROW_SQL}, coalesce(artist_names, 'Unknown Artist') AS artist_names,
        coalesce(track_name, 'Unknown Track') AS track_name, coalesce(label, 'Independent') AS label FROM chart""",
    lambda df: df.select(*ROW, *K.DEFAULTS).fillna(K.DEFAULTS),
)
over_bronze(
    "require_not_null",
    f"""SELECT {ROW_SQL}, label, release_date FROM chart
        WHERE label IS NOT NULL AND release_date IS NOT NULL AND artist_names IS NOT NULL""",
    lambda df: df.na.drop(subset=["label", "release_date", "artist_names"]).select(*ROW, "label", "release_date"),
)
over_bronze(
    "trim_text",
    f"SELECT {ROW_SQL}, trim(artist_names, ' ') AS artist_names, trim(label, ' ') AS label FROM chart",
    lambda df: df.select(*ROW, F.trim("artist_names").alias("artist_names"), F.trim("label").alias("label")),
)
over_bronze(
    "standardize_label",
    f"SELECT label, {initcap('label')} AS standardized_label, {initcap('artist_names')} AS standardized_artist, count(*) AS n "
    "FROM chart GROUP BY ALL",
    lambda df: df.select(
        "label",
        clean.standardize("label").alias("standardized_label"),
        clean.standardize("artist_names").alias("standardized_artist"),
    )
    .groupBy("label", "standardized_label", "standardized_artist")
    .agg(F.count(F.lit(1)).alias("n")),
)
over_bronze(
    "sentinel_to_null",
    f"SELECT {ROW_SQL}, nullif(previous_rank, -1) AS previous_rank FROM chart",
    lambda df: df.select(*ROW, clean.sentinel_to_null("previous_rank", -1).alias("previous_rank")),
)
over_bronze(
    "parse_date",
    f"""SELECT {ROW_SQL}, CAST(try_strptime(CAST(release_date AS VARCHAR), '%Y-%m-%d') AS DATE) AS parsed,
        CAST(try_strptime(track_name, '%Y-%m-%d') AS DATE) AS unparsable FROM chart""",
    lambda df: df.withColumn("release_text", F.col("release_date").cast("string")).select(
        *ROW, clean.parse_date("release_text").alias("parsed"), clean.parse_date("track_name").alias("unparsable")
    ),
)
over_bronze(
    "filter_predicates",
    f"""SELECT {ROW_SQL}, label FROM chart WHERE (rank BETWEEN 1 AND 50 AND country IN ('nation_1', 'nation_2', 'global'))
        OR (starts_with(uri, 'track:1') AND contains(artist_names, '|') AND NOT streams < 20000)
        OR (label IS NULL AND uri LIKE 'track:8%')""",
    lambda df: df.filter(
        (F.col("rank").between(1, 50) & F.col("country").isin("nation_1", "nation_2", "global"))
        | (F.col("uri").startswith("track:1") & F.col("artist_names").contains("|") & ~(F.col("streams") < 20000))
        | (F.col("label").isNull() & F.col("uri").like("track:8%"))
    ).select(*ROW, "label"),
)
query(
    "exclude_period",
    over_silver("SELECT year, month, count(*) AS n FROM silver WHERE NOT (year = 2001 AND month = 8) GROUP BY ALL"),
)(
    lambda spark, sf: G.exclude_period(silver(spark, sf), (2001, 8))
    .groupBy("year", "month")
    .agg(F.count(F.lit(1)).alias("n"))
)

# --- row-level features -------------------------------------------------------------------

over_bronze(
    "time_parts",
    f"""SELECT {ROW_SQL}, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
        CAST(quarter(date) AS INT) AS quarter, CAST(week(date) AS INT) AS week FROM chart""",
    lambda df: df.select(
        *ROW, F.year("date").alias("year"), F.month("date").alias("month"), F.quarter("date").alias("quarter"),
        F.weekofyear("date").alias("week"),
    ),
)
over_bronze(
    "hit_category",
    f"SELECT {ROW_SQL}, {HIT_CATEGORY} AS hit_category FROM chart",
    lambda df: df.select(*ROW, features.hit_category().alias("hit_category")),
)
over_bronze(
    "chart_strength_raw",
    f"SELECT {ROW_SQL}, {SCORE} AS chart_strength_score FROM chart",
    lambda df: df.select(*ROW, features.chart_strength_raw().alias("chart_strength_score")),
)
for _name, _columns in {
    "chart_strength_normalized": ("rank", "peak_rank", "days_on_chart", "consecutive_days", "chart_strength_score"),
    "valid_release_date": ("release_date", "valid_release_date"),
    "song_age_days": ("valid_release_date", "song_age_days"),
    "song_age_category": ("song_age_days", "song_age_category"),
    "rank_movement": ("rank", "previous_rank", "rank_movement"),
    "movement_category_v2": ("rank_movement", "movement_category"),
    "stream_tier_v2": ("streams", "stream_tier"),
}.items():
    query(_name, over_rich(f"SELECT date, market, uri, {', '.join(_columns)} FROM rich"))(
        lambda spark, sf, columns=_columns: rich(spark, sf).select("date", "market", "uri", *columns)
    )
over_bronze(
    "movement_category_v1",
    f"""SELECT {ROW_SQL}, CASE WHEN m IS NULL THEN 'New Entry' WHEN m >= 50 THEN 'Strong Gainer' WHEN m > 0 THEN 'Gainer'
        WHEN m = 0 THEN 'Stable' WHEN m <= -50 THEN 'Strong Decliner' ELSE 'Decliner' END AS movement_category
        FROM (SELECT *, CASE WHEN previous_rank > 0 THEN previous_rank - rank END AS m FROM chart)""",
    lambda df: df.withColumn("rank_movement", features.rank_movement()).select(
        *ROW, features.movement_category_v1().alias("movement_category")
    ),
)
over_bronze(
    "stream_tier_v1",
    f"""SELECT {ROW_SQL}, CASE WHEN streams >= 10000000 THEN 'Mega Hit' WHEN streams >= 1000000 THEN 'Super Hit'
        WHEN streams >= 100000 THEN 'High Performer' ELSE 'Regular' END AS stream_tier FROM chart""",
    lambda df: df.select(*ROW, features.stream_tier(K.STREAM_TIERS_V1).alias("stream_tier")),
)
query(
    "year_month_label",
    over_silver(
        """SELECT DISTINCT year, month, strftime(make_date(year, month, 1), '%b %Y') AS label,
        printf('%04d-%02d', year, month) AS key FROM silver"""
    ),
)(
    lambda spark, sf: silver(spark, sf)
    .select("year", "month")
    .distinct()
    .select("year", "month", features.year_month_label().alias("label"), features.year_month_key().alias("key"))
)

# --- arrays and multi-valued attributes ---------------------------------------------------

over_bronze(
    "explode_split",
    f"SELECT {ROW_SQL}, unnest({parts('artist_uris')}) AS artist_uri FROM chart",
    lambda df: df.select(*ROW, F.explode(arrays.parts("artist_uris")).alias("artist_uri")),
)
ZIP_SQL = f"""zipped AS (SELECT {ROW_SQL}, artist_uris, artist_names,
  unnest(list_zip(string_split(artist_uris, '|'), string_split(artist_names, '|'))) AS z FROM chart),
credit AS (SELECT {ROW_SQL}, trim(z[1], ' ') AS artist_uri, trim(z[2], ' ') AS artist_name FROM zipped)"""
over_bronze(
    "explode_zip",
    f", {ZIP_SQL} SELECT * FROM credit WHERE artist_uri <> '' AND artist_name <> '' AND artist_name <> 'Unknown Artist'",
    lambda df: df.select(*ROW, F.inline(arrays.named_credits())),
)
TOLERANT_SQL = f"""fitted AS (SELECT *, string_split(artist_uris, '|') AS u, string_split(artist_names, '|') AS n
  FROM chart WHERE artist_names IS NOT NULL),
zipped AS (SELECT {ROW_SQL}, unnest(list_zip(u, CASE WHEN len(n) = len(u) THEN n ELSE list_transform(u, lambda x: artist_names) END)) AS z
  FROM fitted),
credit AS (SELECT {ROW_SQL}, z[1] AS artist_uri, z[2] AS artist_name FROM zipped)"""
over_bronze(
    "explode_zip_tolerant",
    f", {TOLERANT_SQL} SELECT * FROM credit",
    lambda df: df.filter("artist_names is not null").select(*ROW, F.inline(arrays.credits_tolerant())),
)
over_bronze(
    "full_credit_attribution",
    f", {TOLERANT_SQL} SELECT artist_uri, CAST(sum(streams) AS BIGINT) AS total_streams, count(*) AS n FROM credit GROUP BY ALL",
    lambda df: df.filter("artist_names is not null")
    .select("streams", F.inline(arrays.credits_tolerant()))
    .groupBy("artist_uri")
    .agg(F.sum("streams").alias("total_streams"), F.count(F.lit(1)).alias("n")),
)
over_bronze(
    "collab_distribution",
    f""", tracks AS (SELECT uri, count(DISTINCT a) AS artists FROM (SELECT uri, unnest({parts('artist_uris')}) AS a FROM chart) GROUP BY uri)
    SELECT artists, count(*) AS tracks, CAST(artists > 1 AS BOOLEAN) AS is_collab FROM tracks GROUP BY artists""",
    lambda df: df.select("uri", F.explode(arrays.parts("artist_uris")).alias("a"))
    .groupBy("uri")
    .agg(F.countDistinct("a").alias("artists"))
    .groupBy("artists")
    .agg(F.count(F.lit(1)).alias("tracks"))
    .withColumn("is_collab", F.col("artists") > 1),
)
over_bronze(
    "separator_census",
    """SELECT unnest([',', '|', ';']) AS separator, unnest([count(*) FILTER (WHERE contains(artist_names, ',')),
       count(*) FILTER (WHERE contains(artist_names, '|')), count(*) FILTER (WHERE contains(artist_names, ';'))]) AS n FROM chart""",
    lambda df: df.agg(*(F.count_if(F.col("artist_names").contains(s)).alias(s) for s in (",", "|", ";"))).select(
        F.inline(F.array(*(F.struct(F.lit(s).alias("separator"), F.col(f"`{s}`").alias("n")) for s in (",", "|", ";"))))
    ),
)
