"""Dashboard metrics and templated questions."""

from pyspark.sql import functions as F

from chartlake.operators import metrics as M
from chartlake.plans import gold as G
from chartlake.plans.catalog.base import IS_HIT, STREAMS, over_silver, pct, query, silver, stored
from chartlake.plans.catalog.gold import ARTISTS_RANKED, COUNTRY_PERFORMANCE, KEY

COUNTRY = "Country 5"


def over(name: str, sql: str, build, table=G.country_performance, cte: str = COUNTRY_PERFORMANCE) -> None:
    """Register a query over one monthly table."""
    query(name, over_silver(f"{cte} {sql}"))(lambda spark, sf: build(table(silver(spark, sf))))


over(
    "filter_options",
    """SELECT DISTINCT 'year' AS kind, CAST(year AS VARCHAR) AS value FROM country_performance
       UNION ALL SELECT DISTINCT 'country', country_name FROM country_performance""",
    M.filter_options,
)
PERIOD = f"""SELECT year, month, CAST(sum(total_streams) AS BIGINT) AS total_streams, CAST(sum(active_artists) AS BIGINT) AS active_artists,
  CAST(sum(active_songs) AS BIGINT) AS active_songs, CAST(sum(hit_songs) AS BIGINT) AS hit_songs,
  count(DISTINCT country_name) AS countries_covered,
  CAST(sum(hit_songs) AS DOUBLE) / nullif(sum(active_songs), 0) * 100 AS catalog_hit_rate FROM country_performance"""
over("period_aggregate", f"{PERIOD} GROUP BY year, month", M.period_aggregate)
over("period_aggregate_country", f"{PERIOD} WHERE country_name = '{COUNTRY}' GROUP BY year, month",
     lambda df: M.period_aggregate(df, COUNTRY))


def cards_sql(where: str, covered: str) -> str:
    change = "(n.{m} - b.{m}) / CAST(nullif(b.{m}, 0) AS DOUBLE) * 100"
    text = "coalesce(printf('%+.1f%%', {c}), '—')"
    arrow = "CASE WHEN {c} < 0 THEN 'down' ELSE 'up' END"
    s, a = (change.format(m=m) for m in ("total_streams", "active_artists"))
    return f""", p AS ({PERIOD} {where} GROUP BY year, month ORDER BY year DESC, month DESC LIMIT 2),
  n AS (SELECT * FROM p ORDER BY year DESC, month DESC LIMIT 1), b AS (SELECT * FROM p ORDER BY year, month LIMIT 1)
  SELECT 'total-streams' AS id, printf('Total Streams (%04d-%02d)', n.year, n.month) AS label,
    printf('%.2fB', n.total_streams / CAST(1e9 AS DOUBLE)) AS value, {text.format(c=s)} AS delta, {arrow.format(c=s)} AS trend FROM n, b
  UNION ALL SELECT 'active-artists', 'Active Artists', format('{{:,}}', n.active_artists), {text.format(c=a)}, {arrow.format(c=a)} FROM n, b
  UNION ALL SELECT 'countries-covered', 'Countries Covered', {covered}, '—', 'up' FROM n
  UNION ALL SELECT 'catalog-hit-rate', 'Catalog Hit Rate', printf('%.1f%%', n.catalog_hit_rate), '—', 'up' FROM n"""


over("kpi_cards", cards_sql("", "CAST(n.countries_covered AS VARCHAR)"), M.kpi_cards)
over("kpi_cards_scoped", cards_sql(f"WHERE country_name = '{COUNTRY}' AND year = 1999", "'1'"),
     lambda df: M.kpi_cards(df, 1999, COUNTRY))
PERIOD_KEY = "printf('%04d-%02d', year, month) AS period"
over("series_streams",
     f"SELECT {PERIOD_KEY}, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM country_performance GROUP BY year, month",
     M.series_streams)
over("series_hit_rate",
     f"SELECT {PERIOD_KEY}, {pct('sum(hit_songs)', 'sum(active_songs)', 1)} AS hit_rate FROM country_performance GROUP BY year, month",
     M.series_hit_rate)
over(
    "top_countries_year",
    """SELECT year, country_name, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM country_performance
       WHERE year = (SELECT max(year) FROM country_performance) GROUP BY ALL ORDER BY total_streams DESC, country_name LIMIT 8""",
    M.top_countries_year,
)
over(
    "top_artists",
    f"""SELECT artist_name, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM artist_performance
        WHERE year = 1998 AND country_name = '{COUNTRY}' GROUP BY ALL ORDER BY total_streams DESC, artist_name LIMIT 8""",
    lambda df: M.top_artists(df, 1998, COUNTRY),
    G.artist_performance_ranked, ARTISTS_RANKED,
)
over("ask_count_distinct", "SELECT count(DISTINCT artist_uri) AS value FROM artist_performance",
     lambda df: M.ask_count_distinct(df, "artist_uri"), G.artist_performance_ranked, ARTISTS_RANKED)
KPI_SONG = f""", kpi_song AS (SELECT {KEY}, uri, standardized_label, {STREAMS} AS total_streams,
  max(CASE WHEN {IS_HIT} THEN 1 ELSE 0 END) AS is_hit FROM silver GROUP BY ALL)"""
over("ask_count_hits", "SELECT count(DISTINCT uri) AS value FROM kpi_song WHERE is_hit = 1 AND year = 1997",
     lambda df: M.ask_count_hits(df, 1997), G.kpi_song, KPI_SONG)
over("ask_sum",
     "SELECT CAST(coalesce(sum(total_streams), 0) AS BIGINT) AS value FROM country_performance "
     "WHERE year = 1996 AND country_name IN ('Country 1', 'Country 2')",
     lambda df: M.ask_sum(df, "country_name", ["Country 1", "Country 2"], 1996))
over(
    "ask_superlative",
    """SELECT artist_uri, artist_name, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM artist_performance
       GROUP BY ALL ORDER BY total_streams DESC, artist_uri, artist_name LIMIT 5""",
    lambda df: M.ask_superlative(df, "artist_uri", "artist_name"), G.artist_performance_ranked, ARTISTS_RANKED,
)
over(
    "ask_superlative_lowest",
    """SELECT country_name, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM country_performance
       GROUP BY ALL ORDER BY total_streams, country_name LIMIT 5""",
    lambda df: M.ask_superlative(df, "country_name", ascending=True),
)
TREND = """, y AS (SELECT {key} AS k, year, CAST(sum(total_streams) AS BIGINT) AS total FROM {table} {where} GROUP BY ALL)
  SELECT a.k AS {key}, a.total AS target_total, coalesce(b.total, 0) AS previous_total, a.total - coalesce(b.total, 0) AS growth
  FROM y a LEFT JOIN y b ON a.k = b.k AND b.year = {previous} WHERE a.year = {target} ORDER BY growth DESC, a.k LIMIT {k}"""
over("ask_trend", TREND.format(key="uri", table="kpi_song", where="", target=1999, previous=1998, k=5),
     lambda df: M.ask_trend(df, "uri", [1999]), G.kpi_song, KPI_SONG)
over(
    "ask_trend_named",
    TREND.format(key="country_name", table="country_performance", where="WHERE country_name IN ('Country 1', 'Country 9')",
                 target=2000, previous=1996, k=2),
    lambda df: M.ask_trend(df, "country_name", [1996, 2000], entities=["Country 1", "Country 9"]),
)


# --- tables of parameters -------------------------------------------------------------------

PARAMS_SQL = """, params AS (SELECT coalesce(CAST(y AS VARCHAR), '*') || '|' || coalesce(c, '*') AS param_id, CAST(y AS INT) AS p_year, c AS p_country FROM (
  SELECT DISTINCT year AS y, country_name AS c FROM country_performance UNION SELECT DISTINCT year, NULL FROM country_performance
  UNION SELECT NULL, country_name FROM country_performance UNION SELECT NULL, NULL))"""
ASKED = "params JOIN country_performance ON (p_country IS NULL OR country_name = p_country) AND (p_year IS NULL OR year = p_year)"
BATCH = f"{PERIOD.replace('SELECT year', 'SELECT param_id, year').replace('FROM country_performance', f'FROM {ASKED}')} GROUP BY param_id, year, month"


def params_of(df):
    """Every year, every country, every pair of them, and all."""
    pairs = df.select("year", F.col("country_name").alias("country")).distinct()
    none_year, none_country = F.lit(None).cast("int").alias("year"), F.lit(None).cast("string").alias("country")
    rows = pairs.unionByName(pairs.select("year", none_country)).unionByName(pairs.select(none_year, "country")).unionByName(
        pairs.select(none_year, none_country)
    ).distinct()
    return rows.withColumn("param_id", F.concat_ws("|", F.coalesce(F.col("year").cast("string"), F.lit("*")), F.coalesce("country", F.lit("*"))))


ASKED_COLUMNS = ("year", "month", "country_name", "total_streams", "active_artists", "active_songs", "hit_songs")


def monthly(spark, sf, table, columns):
    """Columns of a monthly table, written once: the parameters are made from it, too, and the chart is built once for both."""

    def write(path):
        df = table(silver(spark, sf)).select(*columns)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return stored(spark, sf, f"monthly_{table.__name__}", write)


def batch(name: str, sql: str, build, table=G.country_performance, cte: str = COUNTRY_PERFORMANCE, columns=ASKED_COLUMNS) -> None:
    def run(spark, sf):
        df = monthly(spark, sf, table, columns)
        return build(df, params_of(df))

    query(name, over_silver(f"{cte} {sql}"))(run)


CHANGE = "(n.{m} - b.{m}) / CAST(nullif(b.{m}, 0) AS DOUBLE) * 100"
batch("period_aggregate_batch", f"{PARAMS_SQL} {BATCH}", M.period_aggregate_batch)
batch("series_streams_batch", f"{PARAMS_SQL} SELECT param_id, {PERIOD_KEY}, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM {ASKED} GROUP BY param_id, year, month",
      M.series_streams_batch)
batch("series_hit_rate_batch", f"{PARAMS_SQL} SELECT param_id, {PERIOD_KEY}, {pct('sum(hit_songs)', 'sum(active_songs)', 1)} AS hit_rate FROM {ASKED} GROUP BY param_id, year, month",
      M.series_hit_rate_batch)


def cards_batch_sql() -> str:
    text = "coalesce(printf('%+.1f%%', {c}), '—')"
    arrow = "CASE WHEN {c} < 0 THEN 'down' ELSE 'up' END"
    s, a = (CHANGE.format(m=m) for m in ("total_streams", "active_artists"))
    return f""", p AS (SELECT *, row_number() OVER (PARTITION BY param_id ORDER BY year DESC, month DESC) AS r FROM ({BATCH})),
  n AS (SELECT p.*, p_country FROM p JOIN params USING (param_id) WHERE r = 1), b AS (SELECT * FROM p WHERE r = 2), nb AS (SELECT param_id FROM n)
  SELECT n.param_id, 'total-streams' AS id, printf('Total Streams (%04d-%02d)', n.year, n.month) AS label,
    printf('%.2fB', n.total_streams / CAST(1e9 AS DOUBLE)) AS value, {text.format(c=s)} AS delta, {arrow.format(c=s)} AS trend FROM n LEFT JOIN b USING (param_id)
  UNION ALL SELECT n.param_id, 'active-artists', 'Active Artists', format('{{:,}}', n.active_artists), {text.format(c=a)}, {arrow.format(c=a)} FROM n LEFT JOIN b USING (param_id)
  UNION ALL SELECT n.param_id, 'countries-covered', 'Countries Covered', CASE WHEN p_country IS NULL THEN CAST(n.countries_covered AS VARCHAR) ELSE '1' END, '—', 'up' FROM n
  UNION ALL SELECT n.param_id, 'catalog-hit-rate', 'Catalog Hit Rate', printf('%.1f%%', n.catalog_hit_rate), '—', 'up' FROM n"""


batch("kpi_cards_batch", f"{PARAMS_SQL} {cards_batch_sql()}", M.kpi_cards_batch)
batch(
    "top_countries_year_batch",
    PARAMS_SQL + """ , dated AS (SELECT param_id, coalesce(p_year, (SELECT max(year) FROM country_performance)) AS year FROM params WHERE p_country IS NULL),
    t AS (SELECT year, country_name, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM country_performance GROUP BY ALL)
    SELECT param_id, year, country_name, total_streams, CAST(row_number() OVER (PARTITION BY param_id ORDER BY total_streams DESC, country_name) AS INT) AS position
    FROM dated JOIN t USING (year) QUALIFY position <= 8""",
    lambda df, params: M.top_countries_year_batch(df, params.filter("country is null")),
)
batch(
    "top_artists_batch",
    f"""{PARAMS_SQL.replace('FROM country_performance', 'FROM artist_performance')}, t AS (SELECT param_id, artist_name, CAST(sum(total_streams) AS BIGINT) AS total_streams
      FROM params JOIN artist_performance ON (p_country IS NULL OR country_name = p_country) AND (p_year IS NULL OR year = p_year)
      WHERE artist_name IS NOT NULL GROUP BY ALL)
    SELECT *, CAST(row_number() OVER (PARTITION BY param_id ORDER BY total_streams DESC, artist_name) AS INT) AS position FROM t QUALIFY position <= 8""",
    M.top_artists_batch, G.artist_performance_ranked, ARTISTS_RANKED, ("year", "country_name", "artist_name", "total_streams"),
)
