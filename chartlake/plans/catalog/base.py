"""Registry and the SQL text shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartlake import fixtures
from chartlake.plans import silver as S
from chartlake.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.chart_bronze(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_chart(bronze(spark, sf_dir), countries=fixtures.CHART_COUNTRIES)


def rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_chart_rich(bronze(spark, sf_dir), countries=fixtures.CHART_COUNTRIES)


_STORED: dict[tuple[str, str, str], object] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> object:
    """What write(path) gives, written once per session and input folder and read by every query that asks for the name.

    The inputs of a folder are taken to stay as they are while the session lasts.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = write(work_dir(spark, name))
    return _STORED[key]


def r2(x: str, digits: int = 2) -> str:
    """Half-up rounding of a double, digit by digit, as Spark does it."""
    return f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x}, ' ')), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def parts(x: str) -> str:
    """Trimmed, non-empty pipe-delimited parts."""
    return f"list_filter(list_transform(string_split({x}, '|'), lambda p: trim(p, ' ')), lambda p: p <> '')"


CHART_CTE = "chart AS (" + fixtures.CHART_SQL.format(
    **{t: t for t in ("lineitem", "orders", "customer", "nation", "part")}
) + ")"

REST = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (
        "rank", "artist_names", "track_name", "label", "peak_rank", "previous_rank", "days_on_chart",
        "consecutive_days", "artist_uris", "release_date",
    )
)

COUNTRY_NAME = (
    "CASE WHEN country = 'global' THEN 'Global' WHEN country = 'nation_24' THEN NULL "
    "ELSE 'Country ' || substr(country, 8) END"
)

HIT_CATEGORY = (
    "CASE WHEN rank <= 10 THEN 'Global Hit' WHEN rank <= 50 THEN 'Major Hit' "
    "WHEN rank <= 100 THEN 'Popular Track' ELSE 'Charting Track' END"
)

SCORE = r2(
    "(201 - rank) * CAST(0.4 AS DOUBLE) + (201 - peak_rank) * CAST(0.3 AS DOUBLE) "
    "+ days_on_chart * CAST(0.2 AS DOUBLE) + consecutive_days * CAST(0.1 AS DOUBLE)"
)

SILVER_CTE = f"""{CHART_CTE},
clean AS (
  SELECT date, country AS market, rank, uri, trim(coalesce(artist_names, 'Unknown Artist'), ' ') AS artist_names,
    trim(coalesce(track_name, 'Unknown Track'), ' ') AS track_name, trim(coalesce(label, 'Independent'), ' ') AS label,
    peak_rank, previous_rank, days_on_chart, streams, consecutive_days, artist_uris, release_date, {COUNTRY_NAME} AS country_name
  FROM (SELECT *, row_number() OVER (PARTITION BY date, country, uri ORDER BY streams DESC NULLS LAST, {REST}) AS rn FROM chart)
  WHERE rn = 1 AND {COUNTRY_NAME} <> 'Global'),
silver AS (
  SELECT *, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter,
    {HIT_CATEGORY} AS hit_category, {initcap('label')} AS standardized_label, {SCORE} AS chart_strength_score
  FROM clean)"""

RICH_CTE = f"""{SILVER_CTE},
aged AS (
  SELECT * EXCLUDE (chart_strength_score), CAST(week(date) AS INT) AS week,
    CASE WHEN release_date <= date THEN release_date END AS valid_release_date,
    CAST(CASE WHEN release_date <= date THEN date_diff('day', release_date, date) END AS INT) AS song_age_days,
    CAST(CASE WHEN previous_rank > 0 THEN previous_rank - rank END AS INT) AS rank_movement,
    max(days_on_chart) OVER () AS max_days, max(consecutive_days) OVER () AS max_consecutive
  FROM silver),
rich AS (
  SELECT * EXCLUDE (max_days, max_consecutive),
    CASE WHEN song_age_days <= 90 THEN 'New Release' WHEN song_age_days <= 365 THEN 'Recent Hit'
      WHEN song_age_days <= 1825 THEN 'Established' WHEN song_age_days > 1825 THEN 'Evergreen' ELSE 'Unknown' END AS song_age_category,
    CASE WHEN rank_movement IS NULL THEN 'New Entry' WHEN rank_movement >= 50 THEN 'Strong Gainer' WHEN rank_movement >= 5 THEN 'Gainer'
      WHEN rank_movement >= -4 THEN 'Stable' WHEN rank_movement > -50 THEN 'Decliner' ELSE 'Strong Decliner' END AS movement_category,
    CASE WHEN streams >= 5000000 THEN 'Mega Hit' WHEN streams >= 500000 THEN 'Super Hit' WHEN streams >= 50000 THEN 'High Performer'
      ELSE 'Regular' END AS stream_tier,
    {r2('''(201 - rank) / CAST(200 AS DOUBLE) * 40 + (201 - peak_rank) / CAST(200 AS DOUBLE) * 30
      + days_on_chart / CAST(max_days AS DOUBLE) * 20 + consecutive_days / CAST(max_consecutive AS DOUBLE) * 10''')} AS chart_strength_score
  FROM aged)"""

IS_HIT = "hit_category IN ('Global Hit', 'Major Hit')"
AVG_SCORE = r2("CAST(sum(CAST(round(chart_strength_score * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100")
STREAMS = "CAST(sum(streams) AS BIGINT)"


def over_chart(sql: str) -> str:
    return f"WITH {CHART_CTE} {sql}"


def over_silver(sql: str) -> str:
    return f"WITH {SILVER_CTE} {sql}"


def over_rich(sql: str) -> str:
    return f"WITH {RICH_CTE} {sql}"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return r2(f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100", digits)
