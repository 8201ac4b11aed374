"""Profiling and validation queries."""

from pyspark.sql import functions as F

from chartlake import fixtures
from chartlake.functions import arrays
from chartlake.operators import aggregate
from chartlake.operators import quality as Q
from chartlake.plans.catalog.base import STREAMS, bronze, over_chart, over_rich, over_silver, parts, query, r2, rich, silver

COLUMNS = (
    "date", "country", "rank", "uri", "artist_names", "track_name", "label", "peak_rank", "previous_rank",
    "days_on_chart", "streams", "consecutive_days", "artist_uris", "release_date",
)
TEXT = ("artist_names", "track_name", "label")


def over(name: str, sql: str, build) -> None:
    """Register a check of the raw chart."""
    query(name, over_chart(sql))(lambda spark, sf: build(bronze(spark, sf)))


def tidy_sql(rows) -> str:
    """One UNION ALL branch per (column, metric, expression)."""
    return " UNION ALL ".join(
        f"SELECT 'chart' AS table_name, '{c}' AS column_name, '{m}' AS metric, CAST({x} AS DOUBLE) AS value FROM chart"
        for c, m, x in rows
    )


def bad_sql(rows) -> str:
    return tidy_sql([(c, m, f"count(*) FILTER (WHERE {x})") for c, m, x in rows])


over(
    "profile_shape",
    tidy_sql([("*", "rows", "count(*)"), ("*", "columns", "max(14)"), ("*", "numeric_columns", "max(6)"), ("*", "text_columns", "max(6)")]),
    lambda df: Q.profile_shape(df, "chart"),
)
over(
    "profile_types",
    " UNION ALL ".join(
        f"""SELECT 'chart' AS table_name, '{c}' AS column_name, CASE any_value(typeof({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
        ELSE lower(any_value(typeof({c}))) END AS data_type, count(*) AS rows, count({c}) AS present FROM chart""" for c in COLUMNS
    ),
    lambda df: Q.profile_types(df, "chart"),
)
over(
    "profile_nulls",
    tidy_sql(
        [(c, "nulls", f"count(*) FILTER (WHERE {c} IS NULL)") for c in COLUMNS]
        + [(c, "null_percent", r2(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100")) for c in COLUMNS]
    ),
    lambda df: Q.profile_nulls(df, "chart"),
)
over(
    "profile_missing_tokens",
    bad_sql([(c, "missing", f"{c} IS NULL OR trim({c}, ' ') IN ('', 'NULL', '\\N')") for c in TEXT]),
    lambda df: Q.profile_missing_tokens(df, "chart", TEXT),
)
over(
    "profile_distinct",
    tidy_sql([(c, "distinct", f"count(DISTINCT {c})") for c in COLUMNS]),
    lambda df: Q.profile_distinct(df, "chart", COLUMNS),
)
over(
    "profile_duplicates",
    " UNION ALL ".join(
        f"""SELECT 'chart' AS table_name, '{label}' AS column_name, unnest(['rows', 'distinct', 'duplicates', 'duplicate_percent']) AS metric,
        unnest([CAST(t AS DOUBLE), d, t - d, {r2('CAST(t - d AS DOUBLE) / t * 100', 4)}]) AS value
        FROM (SELECT sum(n) AS t, count(*) AS d FROM (SELECT count(*) AS n FROM chart GROUP BY {keys}))"""
        for label, keys in (("*", ", ".join(COLUMNS)), ("date,country,uri", "date, country, uri"))
    ),
    lambda df: Q.profile_duplicates(df, "chart").unionByName(Q.profile_duplicates(df, "chart", ["date", "country", "uri"])),
)
RANGE = ("date", "rank", "streams", "release_date", "days_on_chart")
over(
    "profile_range",
    " UNION ALL ".join(
        f"SELECT 'chart' AS table_name, '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM chart" for c in RANGE
    ),
    lambda df: Q.profile_range(df, "chart", RANGE),
)
over(
    "check_domain",
    bad_sql(
        [(c, "outside 1-200", f"{c} NOT BETWEEN 1 AND 200") for c in ("rank", "peak_rank", "previous_rank")]
        + [(c, "not positive", f"{c} <= 0") for c in ("streams", "days_on_chart", "consecutive_days")]
    ),
    lambda df: Q.count_violations(df, "chart", Q.domain_rules(("rank", "peak_rank", "previous_rank"))),
)
over(
    "check_date_parse",
    bad_sql([(c, "unparsable date", f"{c} IS NOT NULL AND try_strptime(CAST({c} AS VARCHAR), '%Y-%m-%d') IS NULL")
             for c in ("release_date", "label")]),
    lambda df: Q.count_violations(
        df.withColumn("release_date", F.col("release_date").cast("string")), "chart",
        Q.date_parse_rules(["release_date", "label"]),
    ),
)
# The derived chart has no entry dates; a day count back from the chart date gives them.
DATED = "(SELECT *, date - CAST(days_on_chart AS INT) AS entry_date, date - CAST(consecutive_days AS INT) AS peak_date FROM chart)"
DATE_PAIRS = (("release_date", "date"), ("entry_date", "peak_date"), ("entry_date", "date"), ("release_date", "entry_date"))
over(
    "check_date_order",
    " UNION ALL ".join(
        f"SELECT 'chart' AS table_name, '{a}' AS column_name, 'after {b}' AS metric, "
        f"CAST(count(*) FILTER (WHERE {a} > {b}) AS DOUBLE) AS value FROM {DATED}" for a, b in DATE_PAIRS
    ),
    lambda df: Q.count_violations(
        d := df.withColumn("entry_date", F.date_sub("date", F.col("days_on_chart")))
        .withColumn("peak_date", F.date_sub("date", F.col("consecutive_days"))),
        "chart", Q.date_order_rules(d),
    ),
)
over(
    "check_date_order_by_track",
    """SELECT uri, count(*) AS n, CAST(max(date_diff('day', date, release_date)) AS INT) AS max_days_early
       FROM chart WHERE release_date > date GROUP BY uri""",
    Q.late_release_by_track,
)
STATUS = "CASE WHEN previous_rank = -1 THEN 'NEW' WHEN peak_rank < 50 THEN 'MOVE_UP' WHEN peak_rank < 100 THEN 'MOVE_DOWN' ELSE 'SAME_POSITION' END"
over(
    "check_consistency",
    bad_sql(
        [("consecutive_days", "above days_on_chart", "consecutive_days > days_on_chart"),
         ("entry_status", "SAME_POSITION moved", f"({STATUS}) = 'SAME_POSITION' AND previous_rank - rank <> 0"),
         ("entry_status", "MOVE_UP not up", f"({STATUS}) = 'MOVE_UP' AND previous_rank - rank <= 0"),
         ("entry_status", "MOVE_DOWN not down", f"({STATUS}) = 'MOVE_DOWN' AND previous_rank - rank >= 0")]
    ),
    lambda df: Q.count_violations(df.withColumn("entry_status", F.expr(STATUS)), "chart", Q.consistency_rules("entry_status")),
)
over(
    "check_format",
    bad_sql(
        [("uri", "not prefixed track:1", "NOT starts_with(uri, 'track:1')"),
         ("artist_uris", "without artist:", "NOT contains(artist_uris, 'artist:')"),
         ("country", "length not 8", "length(country) <> 8")]
    ),
    lambda df: Q.count_violations(df, "chart", Q.format_rules("track:1", "artist:", "country", 8)),
)
over("check_format_length", "SELECT CAST(length(uri) AS INT) AS length, count(*) AS n FROM chart GROUP BY ALL",
     lambda df: Q.length_histogram(df, "uri"))
over(
    "check_whitespace_blank",
    bad_sql([(c, "untrimmed", f"{c} <> trim({c}, ' ')") for c in TEXT] + [(c, "blank", f"trim({c}, ' ') = ''") for c in TEXT]),
    lambda df: Q.count_violations(df, "chart", Q.whitespace_rules(TEXT)),
)
over(
    "check_case_variants",
    """SELECT lower(trim(label, ' ')) AS folded, count(DISTINCT label) AS spellings, count(*) AS n FROM chart WHERE label IS NOT NULL
       GROUP BY 1 HAVING count(DISTINCT label) > 1""",
    lambda df: Q.case_variants(df, "label"),
)
query(
    "check_unique_key",
    """SELECT 'id' AS what, CAST(p_partkey AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1
       UNION ALL SELECT 'name', p_name, count(*) FROM part GROUP BY ALL HAVING count(*) > 1""",
)(
    lambda spark, sf: Q.repeated_values(fixtures.table(spark, sf, "part").withColumn("k", F.col("p_partkey").cast("string")), "k")
    .select(F.lit("id").alias("what"), "value", "n")
    .unionByName(Q.repeated_values(fixtures.table(spark, sf, "part"), "p_name").select(F.lit("name").alias("what"), "value", "n"))
)

COVERAGE = """SELECT '{kind}' AS kind, count(c.key) AS in_chart, count(m.key) AS in_metadata,
  count(*) FILTER (WHERE m.key IS NULL) AS chart_without_metadata, count(*) FILTER (WHERE c.key IS NULL) AS metadata_without_chart
  FROM (SELECT DISTINCT {chart} AS key FROM silver) c FULL JOIN (SELECT DISTINCT {listed}) m ON c.key = m.key"""


@query(
    "coverage_between",
    over_silver(
        " UNION ALL ".join(
            COVERAGE.format(kind=k, chart=c, listed=m)
            for k, c, m in (
                ("song", "uri", "'track:' || p_partkey AS key FROM part"),
                ("artist", f"unnest({parts('artist_uris')})", "'artist:' || s_suppkey AS key FROM supplier"),
                ("label", "standardized_label", "p_brand AS key FROM part"),
            )
        )
    ),
)
def coverage_between(spark, sf):
    s = silver(spark, sf)
    songs, artists = fixtures.song_metadata(spark, sf), fixtures.artist_metadata(spark, sf)
    return Q.coverage_between(
        {
            "song": (s.select(F.col("uri").alias("key")), songs.select(F.col("track_uri").alias("key"))),
            "artist": (
                s.select(F.explode(arrays.parts("artist_uris")).alias("key")),
                artists.select(F.col("artist_uri").alias("key")),
            ),
            "label": (s.select(F.col("standardized_label").alias("key")), songs.select(F.col("label").alias("key"))),
        }
    )


over(
    "missing_by_group",
    """SELECT country, count(*) AS n, count(DISTINCT uri) AS keys_affected FROM chart WHERE artist_names IS NULL GROUP BY country""",
    lambda df: Q.missing_by_group(df, F.col("artist_names").isNull(), "country", "uri"),
)
FEATURES = ("song_age_category", "movement_category", "hit_category", "stream_tier")
query(
    "category_distribution",
    over_rich(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS category, count(*) AS n, count(DISTINCT uri) AS tracks, {STREAMS} AS total_streams "
            "FROM rich GROUP BY ALL" for c in FEATURES
        )
    ),
)(lambda spark, sf: Q.category_distribution(rich(spark, sf), FEATURES))
over(
    "outlier_iqr",
    f""", q AS (SELECT quantile_cont(CAST(streams AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(streams AS DOUBLE), 0.75) AS q3 FROM chart),
    f AS (SELECT q1, q3, q1 - (q3 - q1) * 1.5 AS lower, q3 + (q3 - q1) * 1.5 AS upper FROM q)
    SELECT q1, q3, lower, upper, count(*) FILTER (WHERE streams > upper) AS above, count(*) FILTER (WHERE streams < lower) AS below,
      count(*) AS n, {r2('CAST(count(*) FILTER (WHERE streams > upper) AS DOUBLE) / count(*) * 100')} AS above_percent
    FROM chart, f GROUP BY ALL""",
    lambda df: aggregate.outlier_iqr(df, "streams"),
)
