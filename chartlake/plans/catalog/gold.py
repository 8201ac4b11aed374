"""Cleaned chart and monthly tables."""

from chartlake.plans import gold as G
from chartlake.plans import silver as S
from chartlake.plans.catalog.base import (
    AVG_SCORE, IS_HIT, STREAMS, over_rich, over_silver, parts, pct, query, r2, rich, silver,
)

KEY = "year, month, country_name"
HITS = f"count(DISTINCT CASE WHEN {IS_HIT} THEN uri END)"
LABEL_MONTH = "strftime(make_date(year, month, 1), '%b %Y')"

# Lock-step credits: the shorter side is padded with NULL.
CREDIT = "unnest(list_zip(string_split(artist_uris, '|'), string_split(artist_names, '|')))"
CREDITS_CTE = f"""credit AS (
  SELECT * EXCLUDE z, trim(z[1], ' ') AS artist_uri, trim(z[2], ' ') AS artist_name FROM (SELECT *, {CREDIT} AS z FROM silver))"""
NAMED_CTE = f"""{CREDITS_CTE}, named AS (
  SELECT * FROM credit WHERE artist_uri <> '' AND artist_name <> '' AND artist_name <> 'Unknown Artist')"""


def artists_cte(keys: str) -> str:
    return (
        f"artists AS (SELECT {keys}, count(DISTINCT a) AS active_artists "
        f"FROM (SELECT {keys}, unnest({parts('artist_uris')}) AS a FROM silver) GROUP BY ALL)"
    )


def growth(measure: str, entity: str, fill: str = "NULL") -> str:
    lag = f"lag({measure}) OVER (PARTITION BY {entity} ORDER BY year, month)"
    return f"coalesce({pct(f'({measure} - {lag})', lag)}, {fill})"


query("silver_chart", over_silver("SELECT * FROM silver"))(silver)
query("silver_chart_rich", over_rich("SELECT * FROM rich"))(rich)

query(
    "artist_bridge",
    over_silver(
        f""", {CREDITS_CTE} SELECT DISTINCT uri, artist_uri, artist_name,
        array_to_string(list_transform(string_split(lower(artist_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS standardized_artist_name
        FROM credit WHERE artist_uri IS NOT NULL AND artist_name IS NOT NULL"""
    ),
)(lambda spark, sf: S.artist_bridge(silver(spark, sf)))

query(
    "kpi_song",
    over_silver(
        f"""SELECT {KEY}, uri, standardized_label, {STREAMS} AS total_streams,
        CAST(max(CASE WHEN {IS_HIT} THEN 1 ELSE 0 END) AS INT) AS is_hit FROM silver GROUP BY ALL"""
    ),
)(lambda spark, sf: G.kpi_song(silver(spark, sf)))

query(
    "kpi_song_rolled_up",
    over_silver(
        f"""SELECT {KEY}, uri, {STREAMS} AS total_streams,
        CAST(max(CASE WHEN {IS_HIT} THEN 1 ELSE 0 END) AS INT) AS is_hit FROM silver GROUP BY ALL"""
    ),
)(lambda spark, sf: G.kpi_song_rolled_up(G.kpi_song(silver(spark, sf))))

query(
    "kpi_artist",
    over_silver(f"SELECT DISTINCT {KEY}, unnest({parts('artist_uris')}) AS artist_uri FROM silver"),
)(lambda spark, sf: G.kpi_artist(silver(spark, sf)))

COUNTRY_PERFORMANCE = f""", {artists_cte(KEY)}, {CREDITS_CTE}, base AS (
  SELECT {KEY}, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs, {HITS} AS hit_songs, {AVG_SCORE} AS avg_chart_strength
  FROM silver GROUP BY ALL),
song AS (SELECT {KEY}, track_name, sum(streams) AS s FROM silver WHERE track_name <> 'Unknown Track' GROUP BY ALL),
top_song AS (SELECT {KEY}, track_name AS top_song_name FROM song
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY s DESC, track_name) = 1),
singer AS (SELECT {KEY}, artist_name, artist_uri, sum(streams) AS s FROM credit WHERE artist_name <> 'Unknown Artist' GROUP BY ALL),
top_artist AS (SELECT {KEY}, artist_name AS top_artist_name FROM singer
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY s DESC, artist_name) = 1),
country_performance AS (
  SELECT base.*, active_artists, CAST(sum(total_streams) OVER (PARTITION BY year, month) AS BIGINT) AS monthly_total_streams,
    top_song_name, top_artist_name, {growth('total_streams', 'country_name')} AS growth_percentage
  FROM base LEFT JOIN artists USING (year, month, country_name) LEFT JOIN top_song USING (year, month, country_name)
  LEFT JOIN top_artist USING (year, month, country_name))"""
query("country_performance", over_silver(f"{COUNTRY_PERFORMANCE} SELECT * FROM country_performance"))(
    lambda spark, sf: G.country_performance(silver(spark, sf))
)

query(
    "country_performance_v2",
    over_silver(
        f""", {artists_cte(KEY)}, base AS (
  SELECT {KEY}, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs, {HITS} AS hit_songs,
    count(DISTINCT standardized_label) AS active_labels FROM silver GROUP BY ALL),
top_artist AS (SELECT {KEY}, artist_names AS top_artist FROM silver GROUP BY {KEY}, artist_names
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY sum(streams) DESC, artist_names) = 1),
top_label AS (SELECT {KEY}, standardized_label AS top_label FROM silver GROUP BY {KEY}, standardized_label
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY sum(streams) DESC, standardized_label) = 1)
SELECT year, month, {LABEL_MONTH} AS year_month, country_name, total_streams,
  {pct('total_streams', 'sum(total_streams) OVER (PARTITION BY year, month)')} AS market_share,
  {growth('total_streams', 'country_name', '0')} AS growth_percentage, {pct('hit_songs', 'active_songs')} AS catalog_hit_rate,
  active_songs, active_artists, active_labels, top_artist, top_label
FROM base LEFT JOIN artists USING (year, month, country_name) LEFT JOIN top_artist USING (year, month, country_name)
LEFT JOIN top_label USING (year, month, country_name)"""
    ),
)(lambda spark, sf: G.country_performance_v2(silver(spark, sf)))

MONTHLY_TRENDS = f""", {artists_cte(KEY)}, base AS (
  SELECT {KEY}, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs, count(DISTINCT standardized_label) AS active_labels,
    {HITS} AS hit_songs, {AVG_SCORE} AS avg_chart_strength
  FROM silver WHERE NOT (year = 2001 AND month = 8) GROUP BY ALL),
monthly_trends AS (
  SELECT base.*, active_artists, {growth('total_streams', 'country_name')} AS growth_percentage
  FROM base LEFT JOIN artists USING (year, month, country_name))"""
query("monthly_trends", over_silver(f"{MONTHLY_TRENDS} SELECT * FROM monthly_trends"))(
    lambda spark, sf: G.monthly_trends(silver(spark, sf), **OPTIONS["monthly_trends"])
)

query(
    "monthly_trends_global",
    over_silver(
        f""", {artists_cte('year, month')}, base AS (
  SELECT year, month, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs,
    count(DISTINCT standardized_label) AS active_labels FROM silver GROUP BY ALL)
SELECT base.*, active_artists, {LABEL_MONTH} AS year_month FROM base LEFT JOIN artists USING (year, month)"""
    ),
)(lambda spark, sf: G.monthly_trends_global(silver(spark, sf)))

query(
    "dashboard_summary",
    over_silver(
        f""", {artists_cte('year, month')}, base AS (
  SELECT year, month, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs,
    count(DISTINCT standardized_label) AS active_labels, count(DISTINCT country_name) AS countries_covered, {HITS} AS hit_songs
  FROM silver GROUP BY ALL)
SELECT base.*, active_artists, {pct('hit_songs', 'active_songs')} AS catalog_hit_rate, {LABEL_MONTH} AS year_month
FROM base LEFT JOIN artists USING (year, month)"""
    ),
)(lambda spark, sf: G.dashboard_summary(silver(spark, sf)))

# Remap entries that occur in the derived chart, so that the lookup has work to do.
CHART_REMAPS = ({"Brand#1": "Columbia", "Brand#2": "Columbia"}, {"Independent": "Republic Records"})
#: Arguments that fit the derived chart.
OPTIONS = {"monthly_trends": {"excluded": ((2001, 8),)}, "label_performance_enhanced": {"remaps": CHART_REMAPS}}


def remapped(x: str) -> str:
    first = f"CASE WHEN {x} IN ('Brand#1', 'Brand#2') THEN 'Columbia' ELSE {x} END"
    return f"CASE WHEN ({first}) = 'Independent' THEN 'Republic Records' ELSE ({first}) END"


LABELS_ENHANCED = f""", label_performance_enhanced AS (
  SELECT {KEY}, {remapped('standardized_label')} AS standardized_label, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs,
    count(DISTINCT artist_names) AS active_artists FROM silver GROUP BY ALL)"""
query(
    "label_performance_enhanced", over_silver(f"{LABELS_ENHANCED} SELECT * FROM label_performance_enhanced")
)(lambda spark, sf: G.label_performance_enhanced(silver(spark, sf), **OPTIONS["label_performance_enhanced"]))

query(
    "label_performance",
    over_silver(
        f""", {artists_cte('year, month, standardized_label')}, base AS (
  SELECT year, month, standardized_label, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs, {HITS} AS hit_songs
  FROM silver GROUP BY ALL)
SELECT year, month, {LABEL_MONTH} AS year_month, standardized_label, total_streams,
  {pct('total_streams', 'sum(total_streams) OVER (PARTITION BY year, month)')} AS market_share,
  {pct('hit_songs', 'active_songs')} AS catalog_hit_rate, active_songs, active_artists
FROM base LEFT JOIN artists USING (year, month, standardized_label)"""
    ),
)(lambda spark, sf: G.label_performance(silver(spark, sf)))

query(
    "artist_performance",
    over_silver(
        f""", {NAMED_CTE} SELECT {KEY}, artist_uri, min(artist_name) AS artist_name, {STREAMS} AS total_streams,
  count(DISTINCT uri) AS active_songs, {HITS} AS hit_songs, {AVG_SCORE} AS avg_chart_strength FROM named GROUP BY {KEY}, artist_uri"""
    ),
)(lambda spark, sf: G.artist_performance(silver(spark, sf)))

query(
    "artist_performance_global",
    over_silver(
        f""", {CREDITS_CTE} SELECT year, month, {LABEL_MONTH} AS year_month, artist_uri, artist_name, {STREAMS} AS total_streams,
  count(DISTINCT uri) AS active_songs, count(DISTINCT country_name) AS countries_reached,
  {pct(HITS, 'count(DISTINCT uri)')} AS catalog_hit_rate, {AVG_SCORE} AS avg_chart_strength
  FROM credit GROUP BY year, month, artist_uri, artist_name"""
    ),
)(lambda spark, sf: G.artist_performance_global(silver(spark, sf)))

TOLERANT_CTE = """fitted AS (
  SELECT *, string_split(artist_uris, '|') AS u, string_split(artist_names, '|') AS n FROM silver),
tolerant AS (
  SELECT * EXCLUDE z, z[1] AS artist_uri, z[2] AS artist_name FROM (SELECT *, unnest(list_zip(u,
    CASE WHEN len(n) = len(u) THEN n ELSE list_transform(u, lambda x: artist_names) END)) AS z FROM fitted))"""
ARTISTS_RANKED = f""", {TOLERANT_CTE}, artist_performance AS (
  SELECT {KEY}, artist_uri, artist_name, {STREAMS} AS total_streams, count(DISTINCT uri) AS track_count,
    CAST(count(*) FILTER (WHERE {IS_HIT}) AS BIGINT) AS hit_track_count, min(rank) AS best_rank,
    printf('%04d-%02d', year, month) AS year_month FROM tolerant GROUP BY {KEY}, artist_uri, artist_name)"""
query("artist_performance_ranked", over_silver(f"{ARTISTS_RANKED} SELECT * FROM artist_performance"))(
    lambda spark, sf: G.artist_performance_ranked(silver(spark, sf))
)

query(
    "artist_country_dominance",
    over_silver(
        f""", {NAMED_CTE}, once AS (
  SELECT {KEY}, date, market, uri, streams, hit_category, chart_strength_score, artist_uri, min(artist_name) AS artist_name
  FROM named GROUP BY ALL),
total AS (SELECT {KEY}, {STREAMS} AS country_total_streams FROM silver GROUP BY ALL),
agg AS (SELECT {KEY}, artist_uri, min(artist_name) AS artist_name, {STREAMS} AS artist_streams, count(DISTINCT uri) AS active_songs,
  {HITS} AS hit_songs, {AVG_SCORE} AS avg_chart_strength FROM once GROUP BY {KEY}, artist_uri)
SELECT agg.*, country_total_streams, {pct('artist_streams', 'country_total_streams')} AS artist_market_share,
  {pct('hit_songs', 'active_songs')} AS catalog_hit_rate FROM agg LEFT JOIN total USING (year, month, country_name)"""
    ),
)(lambda spark, sf: G.artist_country_dominance(silver(spark, sf)))

query(
    "artist_country_dominance_deduped",
    over_silver(
        f""", {NAMED_CTE}, kept AS (
  SELECT {KEY}, uri, artist_uri, streams, chart_strength_score, CASE WHEN {IS_HIT} THEN 1 ELSE 0 END AS hit, min(artist_name) OVER (PARTITION BY {KEY}, uri, artist_uri) AS artist_name
  FROM named QUALIFY row_number() OVER (PARTITION BY {KEY}, uri, artist_uri ORDER BY streams DESC NULLS LAST, hit DESC, chart_strength_score DESC NULLS LAST) = 1),
total AS (SELECT {KEY}, {STREAMS} AS country_total_streams FROM silver GROUP BY ALL),
agg AS (SELECT {KEY}, artist_uri, min(artist_name) AS artist_name, {STREAMS} AS artist_streams, count(*) AS active_songs, CAST(sum(hit) AS BIGINT) AS hit_songs,
  {AVG_SCORE} AS avg_chart_strength FROM kept GROUP BY {KEY}, artist_uri)
SELECT agg.*, country_total_streams,
  {r2("CASE WHEN country_total_streams > 0 THEN artist_streams / CAST(country_total_streams AS DOUBLE) * 100 ELSE 0 END")} AS artist_market_share,
  {r2("CASE WHEN active_songs > 0 THEN hit_songs / CAST(active_songs AS DOUBLE) * 100 ELSE 0 END")} AS catalog_hit_rate
FROM agg LEFT JOIN total USING (year, month, country_name)"""
    ),
)(lambda spark, sf: G.artist_country_dominance_deduped(silver(spark, sf)))

CATALOG = """, track_catalog AS (
  SELECT uri, track_name FROM silver QUALIFY row_number() OVER (PARTITION BY uri ORDER BY date, track_name) = 1)"""
query("track_catalog", over_silver(f"{CATALOG} SELECT * FROM track_catalog"))(
    lambda spark, sf: G.track_catalog(silver(spark, sf))
)

query(
    "gold_song_charts", over_silver(f"SELECT {', '.join(G.SONG_CHART_COLUMNS)} FROM silver WHERE country_name <> 'Global'")
)(lambda spark, sf: G.gold_song_charts(silver(spark, sf)))
