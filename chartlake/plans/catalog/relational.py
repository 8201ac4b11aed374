"""Joins, aggregates, windows, sorts and set operations."""

from pyspark.sql import functions as F

from chartlake import fixtures
from chartlake.functions import arrays
from chartlake.functions.features import is_hit, percent
from chartlake.operators import aggregate, joins, windows
from chartlake.operators import runs
from chartlake.operators import sketches as K
from chartlake.plans import gold as G
from chartlake.plans.chunks import country_year
from chartlake.session import work_dir
from chartlake.plans.catalog.base import (
    IS_HIT, ORACLES, STREAMS, bronze, over_chart, over_silver, parts, pct, query, r2, silver, stored,
)
from chartlake.plans.catalog.gold import COUNTRY_PERFORMANCE, HITS, KEY, NAMED_CTE, growth


def rows():
    return F.count(F.lit(1))


def over(name: str, sql: str, build) -> None:
    """Register a query over the cleaned chart."""
    query(name, over_silver(sql))(lambda spark, sf: build(silver(spark, sf)))


def totals(df, *keys):
    return df.groupBy(*keys).agg(F.sum("streams").alias("total_streams"))


def total_sql(name: str, *keys: str) -> str:
    return f"{name} AS (SELECT {', '.join(keys)}, {STREAMS} AS total_streams FROM silver GROUP BY ALL)"


# --- joins --------------------------------------------------------------------------------

over(
    "join_left_equi",
    f""", {total_sql('t', 'year', 'month', 'country_name')}, a AS (SELECT {KEY}, count(DISTINCT artist_names) AS credits
    FROM silver WHERE artist_names <> 'Unknown Artist' GROUP BY ALL)
    SELECT t.*, credits FROM t LEFT JOIN a USING (year, month, country_name)""",
    lambda s: totals(s, *G.PLACE).join(
        s.filter("artist_names <> 'Unknown Artist'")
        .groupBy(*G.PLACE)
        .agg(F.countDistinct("artist_names").alias("credits")),
        list(G.PLACE),
        "left",
    ),
)
over(
    "join_inner_equi",
    f""", {total_sql('t', 'year', 'month', 'country_name')}, m AS (SELECT year, month, CAST(sum(total_streams) AS BIGINT) AS monthly_streams
    FROM t GROUP BY ALL) SELECT * FROM t JOIN m USING (year, month)""",
    lambda s: totals(s, *G.PLACE).join(
        totals(s, *G.PLACE).groupBy(*G.MONTH).agg(F.sum("total_streams").alias("monthly_streams")), list(G.MONTH)
    ),
)


@query(
    "join_left_anti",
    over_silver(
        f""", chart_artists AS (SELECT DISTINCT unnest({parts('artist_uris')}) AS key FROM silver),
        list_artists AS (SELECT 'artist:' || s_suppkey AS key FROM supplier),
        chart_labels AS (SELECT DISTINCT standardized_label AS key FROM silver), list_labels AS (SELECT DISTINCT p_brand AS key FROM part),
        chart_songs AS (SELECT DISTINCT uri AS key FROM silver), list_songs AS (SELECT 'track:' || p_partkey AS key FROM part)
        SELECT 'artist without metadata' AS direction, key FROM (SELECT * FROM chart_artists EXCEPT SELECT * FROM list_artists)
        UNION ALL SELECT 'artist without chart', key FROM (SELECT * FROM list_artists EXCEPT SELECT * FROM chart_artists)
        UNION ALL SELECT 'label without metadata', key FROM (SELECT * FROM chart_labels EXCEPT SELECT * FROM list_labels)
        UNION ALL SELECT 'label without chart', key FROM (SELECT * FROM list_labels EXCEPT SELECT * FROM chart_labels)
        UNION ALL SELECT 'song without metadata', key FROM (SELECT * FROM chart_songs EXCEPT SELECT * FROM list_songs)
        UNION ALL SELECT 'song without chart', key FROM (SELECT * FROM list_songs EXCEPT SELECT * FROM chart_songs)"""
    ),
)
def join_left_anti(spark, sf):
    s = silver(spark, sf)
    songs, artists = fixtures.song_metadata(spark, sf), fixtures.artist_metadata(spark, sf)
    sides = {
        "artist": (s.select(F.explode(arrays.parts("artist_uris")).alias("key")), artists.select(F.col("artist_uri").alias("key"))),
        "label": (s.select(F.col("standardized_label").alias("key")), songs.select(F.col("label").alias("key"))),
        "song": (s.select(F.col("uri").alias("key")), songs.select(F.col("track_uri").alias("key"))),
    }
    out = None
    for kind, (chart, listed) in sides.items():
        for gap, left, right in (("metadata", chart, listed), ("chart", listed, chart)):
            part = joins.coverage(left, right, "key").select(F.lit(f"{kind} without {gap}").alias("direction"), "key")
            out = part if out is None else out.unionByName(part)
    return out


@query(
    "join_left_lookup_coalesce",
    over_silver(
        f""", a AS (SELECT artist_uri, {STREAMS} AS total_streams FROM (SELECT streams, unnest({parts('artist_uris')}) AS artist_uri FROM silver)
        GROUP BY ALL) SELECT artist_uri, total_streams, coalesce(s_name, artist_uri) AS name FROM a
        LEFT JOIN (SELECT 'artist:' || s_suppkey AS artist_uri, 'Act ' || s_suppkey AS s_name FROM supplier) USING (artist_uri)"""
    ),
)
def join_left_lookup_coalesce(spark, sf):
    credit = silver(spark, sf).select("streams", F.explode(arrays.parts("artist_uris")).alias("artist_uri"))
    names = fixtures.artist_metadata(spark, sf)
    return joins.lookup_or_key(totals(credit, "artist_uri"), names, "artist_uri", "artist_name", "name").drop("artist_name")


CHANGE_SQL = f""", y AS (SELECT country_name, year, {STREAMS} AS total FROM silver GROUP BY ALL)
    SELECT a.country_name, a.total AS target_total, coalesce(b.total, 0) AS previous_total, a.total - coalesce(b.total, 0) AS growth
    FROM y a LEFT JOIN y b ON a.country_name = b.country_name AND b.year = 1998 WHERE a.year = 1999"""
over(
    "join_self_prior_year",
    CHANGE_SQL,
    lambda s: joins.year_change(s, ["country_name"], 1999, 1998, "streams"),
)


@query(
    "semi_by_list",
    over_silver(
        """SELECT date, market, uri, streams FROM silver WHERE country_name IN ('Country 3', 'Country 7')
        AND uri IN (SELECT 'track:' || p_partkey FROM part WHERE p_size > 40)"""
    ),
)
def semi_by_list(spark, sf):
    big = fixtures.table(spark, sf, "part").filter("p_size > 40").selectExpr("concat('track:', p_partkey) AS uri")
    rows = joins.semi_by_list(silver(spark, sf), "country_name", ["Country 3", "Country 7"])
    return joins.semi_by_list(rows, "uri", big).select("date", "market", "uri", "streams")


over(
    "join_full_outer_rank",
    f""", {total_sql('t', 'uri')}, h AS (SELECT uri, count(*) AS hit_days FROM silver WHERE {IS_HIT} GROUP BY uri),
    a AS (SELECT uri, row_number() OVER (ORDER BY total_streams DESC, uri) AS stream_rank FROM t
      QUALIFY stream_rank <= 50),
    b AS (SELECT uri, row_number() OVER (ORDER BY hit_days DESC, uri) AS hit_rank FROM h QUALIFY hit_rank <= 50)
    SELECT uri, CAST(stream_rank AS INT) AS stream_rank, CAST(hit_rank AS INT) AS hit_rank FROM a FULL JOIN b USING (uri)""",
    lambda s: _ranked(totals(s, "uri"), "total_streams", "stream_rank").join(
        _ranked(s.filter(is_hit()).groupBy("uri").agg(rows().alias("hit_days")), "hit_days", "hit_rank"), "uri", "full"
    ),
)


def _ranked(df, measure, rank):
    """A top-50 report with its ranks; the limit keeps 50 rows before they are numbered."""
    best = windows.sort_topk(df, [F.desc(measure), "uri"], 50)
    return windows.top_k_per_group(best, [], [F.desc(measure), "uri"], 50, rank).select("uri", rank)


# --- aggregates ---------------------------------------------------------------------------

over("agg_sum_by_keys", f"SELECT {KEY}, {STREAMS} AS total_streams FROM silver GROUP BY ALL",
     lambda s: s.groupBy(*G.PLACE).agg(F.round(F.sum("streams"), 0).alias("total_streams")))
over("agg_count_distinct",
     "SELECT country_name, count(DISTINCT uri) AS songs, "
     "count(DISTINCT CASE WHEN release_date IS NOT NULL THEN (uri, release_date) END) AS dated_songs FROM silver GROUP BY ALL",
     lambda s: s.groupBy("country_name").agg(
         F.countDistinct("uri").alias("songs"), F.countDistinct("uri", "release_date").alias("dated_songs")))
over("agg_count_distinct_if", f"SELECT {KEY}, {HITS} AS hit_songs FROM silver GROUP BY ALL",
     lambda s: s.groupBy(*G.PLACE).agg(F.countDistinct(F.when(is_hit(), F.col("uri"))).alias("hit_songs")))
over("agg_flag_any", f"SELECT uri, CAST(max(CASE WHEN {IS_HIT} THEN 1 ELSE 0 END) AS INT) AS is_hit FROM silver GROUP BY ALL",
     lambda s: s.groupBy("uri").agg(F.max(F.when(is_hit(), 1).otherwise(0)).alias("is_hit")))
over("agg_avg_rounded", f"SELECT {KEY}, {r2('CAST(sum(streams) AS DOUBLE) / count(*)')} AS avg_streams FROM silver GROUP BY ALL",
     lambda s: s.groupBy(*G.PLACE).agg(F.round(F.avg("streams"), 2).alias("avg_streams")))
over("agg_first_nonnull", f", {NAMED_CTE} SELECT artist_uri, min(artist_name) AS artist_name FROM named GROUP BY ALL",
     lambda s: s.select(F.inline(arrays.named_credits())).groupBy("artist_uri").agg(F.min("artist_name").alias("artist_name")))
over(
    "agg_last_by_period",
    f""", m AS (SELECT country_name, year, month, max(CASE WHEN release_date IS NOT NULL THEN track_name END) AS top FROM silver GROUP BY ALL)
    SELECT country_name, top AS latest FROM m WHERE top IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY year DESC, month DESC) = 1""",
    lambda s: s.filter("release_date is not null")
    .groupBy(*G.PLACE).agg(F.max("track_name").alias("top"))
    .groupBy("country_name").agg(F.max_by("top", F.struct("year", "month")).alias("latest")),
)
COUNTRY_YEAR = f""", country_year AS (SELECT country_name, year, CAST(sum(total_streams) AS BIGINT) AS total_streams,
  max(active_songs) AS active_songs, max(hit_songs) AS hit_songs,
  {r2('avg(CAST(avg_chart_strength AS DECIMAL(18,2)))', 6)} AS avg_chart_strength, max(active_artists) AS active_artists,
  {r2('avg(CAST(growth_percentage AS DECIMAL(18,2)))', 6)} AS growth_percentage,
  arg_max(top_song_name, month) AS top_song_name, arg_max(top_artist_name, month) AS top_artist_name
  FROM country_performance GROUP BY ALL)"""
query("agg_mixed_rollup_year", over_silver(f"{COUNTRY_PERFORMANCE}{COUNTRY_YEAR} SELECT * FROM country_year"))(
    lambda spark, sf: country_year(G.country_performance(silver(spark, sf)))
)


over("agg_count_if",
     """SELECT country_name, count(*) FILTER (WHERE rank <= 10) AS top10, count(*) FILTER (WHERE release_date IS NULL) AS undated,
     count(*) FILTER (WHERE contains(artist_names, '|')) AS collabs FROM silver GROUP BY ALL""",
     lambda s: s.groupBy("country_name").agg(
         F.count_if(F.col("rank") <= 10).alias("top10"), F.count_if(F.col("release_date").isNull()).alias("undated"),
         F.count_if(F.col("artist_names").contains("|")).alias("collabs")))
over("agg_frequency", "SELECT market, hit_category, count(*) AS n FROM silver GROUP BY ALL",
     lambda s: s.groupBy("market", "hit_category").agg(rows().alias("n")).orderBy(F.desc("n"), "market", "hit_category"))
query("agg_having", over_chart("SELECT date, country, uri, count(*) AS n FROM chart GROUP BY ALL HAVING count(*) > 1"))(
    lambda spark, sf: bronze(spark, sf).groupBy("date", "country", "uri").agg(rows().alias("n")).filter("n > 1")
)
over("agg_two_stage",
     f"SELECT country_name, {STREAMS} AS total_streams, count(DISTINCT (year, month, uri)) AS track_months, min(rank) AS best_rank "
     "FROM silver GROUP BY ALL",
     lambda s: s.groupBy(*G.PLACE, "uri").agg(F.sum("streams").alias("s"), F.min("rank").alias("r"))
     .groupBy("country_name").agg(F.sum("s").alias("total_streams"), rows().alias("track_months"), F.min("r").alias("best_rank")))
over("agg_global",
     f"SELECT {STREAMS} AS total_streams, count(*) AS n, min(date) AS first_date, max(date) AS last_date, "
     "count(DISTINCT uri) AS songs FROM silver",
     lambda s: s.agg(F.sum("streams").alias("total_streams"), rows().alias("n"), F.min("date").alias("first_date"),
                     F.max("date").alias("last_date"), F.countDistinct("uri").alias("songs")))
query("approx_distinct_values")(lambda spark, sf: aggregate.approx_distinct(silver(spark, sf)))

# Sketches of the cleaned chart, written per month; years and the total come from the written months.
SKETCHED = {"songs": "uri", "artists": "artist_names", "labels": "standardized_label"}
LEVELS = ((("month", "year", "month"), "GROUP BY ALL"), (("year", "year", "NULL"), "GROUP BY ALL"), (("all", "NULL", "NULL"), ""))
PROBS = (0.25, 0.5, 0.75, 0.99)


def _months(spark, sf):
    s = silver(spark, sf)
    written = K.sketches(s, G.MONTH, {k: F.col(c) for k, c in SKETCHED.items()}, {"streams": F.col("streams")})
    return stored(spark, sf, "sketches", lambda path: _written(written, path))


def _written(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@query(
    "approx_distinct",
    over_silver(
        " UNION ALL ".join(
            f"SELECT '{level}' AS level, CAST({y} AS INT) AS year, CAST({m} AS INT) AS month, count(*) AS n, "
            + ", ".join(f"count(DISTINCT {c}) AS {k}, true AS {k}_within" for k, c in SKETCHED.items()) + f" FROM silver {grouped}"
            for (level, y, m), grouped in LEVELS
        )
    ),
)
def approx_distinct(spark, sf):
    """Distinct values by month, year and in all: exact, and whether the merged sketch is within its stated error of them."""
    s = silver(spark, sf)
    exact = [F.count_distinct(c).alias(k) for k, c in SKETCHED.items()]
    counts = s.groupBy(F.lit("month").alias("level"), *G.MONTH).agg(*exact)
    counts = counts.unionByName(s.groupBy(F.lit("year").alias("level"), "year", F.lit(None).cast("int").alias("month")).agg(*exact))
    counts = counts.unionByName(s.groupBy(F.lit("all").alias("level"), F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month")).agg(*exact))
    found = K.levels(_months(spark, sf), list(SKETCHED)).select("level", "year", "month", "n", *[K.distinct_of(k).alias(f"_{k}") for k in SKETCHED])
    same = [found[c].eqNullSafe(counts[c]) for c in ("level", "year", "month")]
    within = [(F.abs(F.col(f"_{k}") - F.col(k)) <= K.distinct_error() * F.col(k)).alias(f"{k}_within") for k in SKETCHED]
    return found.join(counts, same[0] & same[1] & same[2]).select(
        found["level"], found["year"], found["month"], "n", *SKETCHED, *within
    )

NUMERIC = ("rank", "peak_rank", "previous_rank", "days_on_chart", "streams", "consecutive_days", "chart_strength_score")
query("approx_quantile_values")(lambda spark, sf: aggregate.approx_quantiles(silver(spark, sf), NUMERIC))


@query(
    "approx_quantiles",
    over_silver(
        " UNION ALL ".join(
            f"SELECT '{level}' AS level, CAST({y} AS INT) AS year, CAST({m} AS INT) AS month, count(*) AS n, p AS prob, true AS within "
            f"FROM silver, unnest([{', '.join(f'CAST({p} AS DOUBLE)' for p in PROBS)}]) AS t(p) GROUP BY ALL"
            for (level, y, m), _ in LEVELS
        )
    ),
)
def approx_quantiles(spark, sf):
    """Quantiles of the streams by month, year and in all, and whether their true ranks are within the sketch's stated error.

    The streams are written once for both sides: the sketches, and the ranks of what they give, which are a few rows a month.
    """
    s = _written(silver(spark, sf).select(*G.MONTH, "streams"), work_dir(spark, "streams"))
    sketched = _written(K.sketches(s, G.MONTH, quantiles={"streams": F.col("streams")}), work_dir(spark, "stream_sketches"))
    found = K.levels(sketched, quantiles=["streams"])
    probs = F.array(*[F.struct(F.lit(p).alias("prob"), K.quantile_of("streams", p).alias("value")) for p in PROBS])
    found = found.select("level", "year", "month", "n", F.inline(probs))
    none = F.lit(None).cast("int")
    periods = F.array(
        F.struct(F.lit("month").alias("l"), F.col("year").alias("y"), F.col("month").alias("m")),
        F.struct(F.lit("year").alias("l"), F.col("year").alias("y"), none.alias("m")), F.struct(F.lit("all").alias("l"), none.alias("y"), none.alias("m")),
    )
    facts = s.groupBy(*G.MONTH, "streams").agg(F.count(F.lit(1)).alias("_rows")).select("streams", "_rows", F.inline(periods))
    same = (F.col("level") == F.col("l")) & F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m"))
    rows = lambda held: F.sum(F.when(held, F.col("_rows")).otherwise(0))
    ranked = facts.join(F.broadcast(found), same).groupBy("level", "year", "month", "n", "prob").agg(
        (rows(F.col("streams") < F.col("value")) / rows(F.col("streams").isNotNull())).alias("low"),
        (rows(F.col("streams") <= F.col("value")) / rows(F.col("streams").isNotNull())).alias("high"),
    )
    within = (F.col("low") - K.rank_error() <= F.col("prob")) & (F.col("prob") <= F.col("high") + K.rank_error())
    return ranked.select("level", "year", "month", "n", "prob", within.alias("within"))
over("exact_quantiles",
     "SELECT unnest([0.25, 0.5, 0.75, 0.99])::DOUBLE AS prob, "
     "unnest(quantile_cont(CAST(streams AS DOUBLE), [0.25, 0.5, 0.75, 0.99])) AS value FROM silver",
     lambda s: aggregate.exact_quantiles(s, "streams", (0.25, 0.5, 0.75, 0.99)))
over(
    "correlation_pairs",
    " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {r2(f'corr({x}, {y})', 6)} AS correlation FROM silver"
        for i, x in enumerate(NUMERIC) for y in NUMERIC[i + 1:]
    ),
    lambda s: aggregate.correlation_pairs(s, NUMERIC),
)
over(
    "describe_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{m}' AS metric, {r2(f'CAST({f}({c}) AS DOUBLE)', 4)} AS value FROM silver"
        for c in NUMERIC
        for m, f in (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"))
    ),
    lambda s: aggregate.describe_numeric(s, NUMERIC),
)
QUARTILES = (0.25, 0.5, 0.75)


@query(
    "summary_with_quartiles",
    ORACLES["describe_numeric"] + "".join(
        f" UNION ALL SELECT '{c}', 'p{round(p * 100)}', {r2(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 4)} FROM silver" for c in NUMERIC for p in QUARTILES
    ),
)
def summary_with_quartiles(spark, sf):
    """Count, mean, spread and ends, and exact interpolated quartiles of every column, in one pass over value counts.

    The numbers of the cleaned chart are written once, so it is built once, not for each statistic.
    """
    s = _written(silver(spark, sf).select(*NUMERIC), work_dir(spark, "numbers"))
    quartiles = aggregate.exact_quartiles(s, NUMERIC, QUARTILES)
    return aggregate.describe_numeric(s, NUMERIC).unionByName(quartiles)

# --- windows, sorts, limits, set operations -----------------------------------------------

over(
    "window_top1_per_group",
    f"""SELECT {KEY}, standardized_label, s AS label_streams FROM (SELECT {KEY}, standardized_label, {STREAMS} AS s FROM silver GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY s DESC, standardized_label) = 1""",
    lambda s: windows.top_k_per_group(
        s.groupBy(*G.PLACE, "standardized_label").agg(F.sum("streams").alias("label_streams")),
        G.PLACE, [F.desc("label_streams"), "standardized_label"]),
)
over(
    "window_topk_per_group",
    f"""SELECT country_name, uri, s AS total_streams, CAST(row_number() OVER (PARTITION BY country_name ORDER BY s DESC, uri) AS INT) AS position
    FROM (SELECT country_name, uri, {STREAMS} AS s FROM silver GROUP BY ALL) QUALIFY position <= 5""",
    lambda s: windows.top_k_per_group(
        totals(s, "country_name", "uri"), ["country_name"], [F.desc("total_streams"), "uri"], 5, "position"),
)
over(
    "window_lag_growth",
    f", {total_sql('t', 'standardized_label', 'year', 'month')} "
    f"SELECT *, {growth('total_streams', 'standardized_label')} AS growth_percentage FROM t",
    lambda s: windows.add_growth(totals(s, "standardized_label", *G.MONTH), ["standardized_label"]),
)
CAL = "PARTITION BY uri ORDER BY year, month"
over(
    "window_lag_growth_calendar",
    f""", {total_sql('t', 'uri', 'year', 'month')}, p AS (SELECT *, CASE WHEN lag(year * 12 + month) OVER ({CAL}) = year * 12 + month - 1
      THEN lag(total_streams) OVER ({CAL}) END AS prev FROM t)
    SELECT * EXCLUDE prev, {pct('(total_streams - prev)', 'prev')} AS growth_percentage FROM p""",
    lambda s: windows.add_growth(totals(s, "uri", *G.MONTH), ["uri"], calendar=True),
)
over(
    "growth_fill_zero",
    f", {total_sql('t', 'country_name', 'year', 'month')} "
    f"SELECT *, {growth('total_streams', 'country_name', '0')} AS growth_percentage FROM t",
    lambda s: windows.add_growth(totals(s, "country_name", *G.MONTH), ["country_name"], fill=0.0),
)
over(
    "share_of_total",
    f", {total_sql('t', 'uri', 'year', 'month')} "
    f"SELECT *, {pct('total_streams', 'sum(total_streams) OVER (PARTITION BY year, month)')} AS market_share FROM t",
    lambda s: windows.share_of_total(totals(s, "uri", *G.MONTH), G.MONTH),
)
over(
    "share_of_total_guarded",
    f""", t AS (SELECT market, {KEY}, count(*) FILTER (WHERE {IS_HIT}) AS hit_days FROM silver GROUP BY ALL)
    SELECT *, {r2("CASE WHEN sum(hit_days) OVER (PARTITION BY year, month) > 0 THEN hit_days / CAST(sum(hit_days) OVER (PARTITION BY year, month) AS DOUBLE) * 100 ELSE 0 END")}
      AS hit_share FROM t""",
    lambda s: windows.share_of_total(
        s.groupBy("market", *G.PLACE).agg(F.count_if(is_hit()).alias("hit_days")), G.MONTH, "hit_days", "hit_share", guarded=True),
)
over(
    "ratio_hit_rate",
    f"SELECT {KEY}, {pct(HITS, 'count(DISTINCT uri)', 1)} AS hit_rate FROM silver GROUP BY ALL",
    lambda s: s.groupBy(*G.PLACE, "uri").agg(F.max(is_hit().cast("int")).alias("hit"))
    .groupBy(*G.PLACE).agg(percent(F.sum("hit"), rows(), 1).alias("hit_rate")),
)
over("sort_topk", f"SELECT uri, {STREAMS} AS total_streams FROM silver GROUP BY ALL ORDER BY total_streams DESC, uri LIMIT 20",
     lambda s: windows.sort_topk(totals(s, "uri"), [F.desc("total_streams"), "uri"], 20))
over("limit_n", "SELECT date, market, uri, rank FROM silver ORDER BY date, market, uri LIMIT 10",
     lambda s: s.select("date", "market", "uri", "rank").orderBy("date", "market", "uri").limit(10))
over("sort_total", f"SELECT country_name, year, {STREAMS} AS total_streams FROM silver GROUP BY ALL ORDER BY ALL",
     lambda s: totals(s, "country_name", "year").orderBy("country_name", "year", F.desc("total_streams")))
over(
    "distinct_on_best",
    f""", {NAMED_CTE}, t AS (SELECT artist_name, artist_uri, sum(streams) AS total FROM named WHERE length(artist_name) >= 5 GROUP BY ALL)
    SELECT artist_name, artist_uri FROM t QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY total DESC, artist_uri) = 1""",
    lambda s: windows.distinct_on_best(
        s.select("streams", F.inline(arrays.named_credits())), "artist_name", "artist_uri", "streams"),
)
over("latest_n_periods", "SELECT DISTINCT year, month FROM silver WHERE country_name = 'Country 4' ORDER BY year DESC, month DESC LIMIT 2",
     lambda s: windows.latest_periods(s.filter("country_name = 'Country 4'")))
over(
    "union_all",
    f"""SELECT 'country' AS grain, country_name AS key, {STREAMS} AS total_streams FROM silver GROUP BY country_name
    UNION ALL SELECT 'track', uri, {STREAMS} FROM silver GROUP BY uri""",
    lambda s: totals(s, "country_name").select(F.lit("country").alias("grain"), F.col("country_name").alias("key"), "total_streams")
    .unionByName(totals(s, "uri").select(F.lit("track").alias("grain"), F.col("uri").alias("key"), "total_streams")),
)
over("distinct_presence", f"SELECT DISTINCT {KEY}, standardized_label FROM silver",
     lambda s: s.select(*G.PLACE, "standardized_label").distinct())


# --- runs on the chart ----------------------------------------------------------------------

RUN_GAP, RUN_EVERGREEN = 7, 15
RUNS_SQL = """days AS (SELECT {keys}, date AS d, CAST(sum(streams) AS BIGINT) AS s FROM silver GROUP BY ALL),
  marked AS (SELECT *, coalesce(d - lag(d) OVER (PARTITION BY {keys} ORDER BY d) > {gap} + 1, true) AS fresh FROM days),
  numbered AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY {keys} ORDER BY d ROWS UNBOUNDED PRECEDING) AS run FROM marked),
  runs AS (SELECT {keys}, min(d) AS run_start, max(d) AS run_end, count(*) AS days, CAST(sum(s) AS BIGINT) AS streams FROM numbered GROUP BY {keys}, run)"""
for _name, _keys in (("chart_runs", ("country_name", "uri")), ("chart_runs_global", ("uri",))):
    over(_name, f", {RUNS_SQL.format(keys=', '.join(_keys), gap=RUN_GAP)} SELECT {', '.join(_keys)}, run_start, run_end, days, streams FROM runs",
         lambda s, keys=_keys: runs.runs(s, keys, gap=RUN_GAP, block_days=90))
over(
    "staying_power",
    f""", {RUNS_SQL.format(keys='uri', gap=RUN_GAP)}, t AS (SELECT uri, count(*) AS runs, CAST(sum(days) AS BIGINT) AS longevity,
      max(run_end - run_start + 1)::BIGINT AS longest_run, (max(run_end) - min(run_start) + 1)::BIGINT AS span_days FROM runs GROUP BY uri)
    SELECT *, {r2('CAST(longevity AS DOUBLE) / span_days * 100')} AS sustainability, longest_run >= {RUN_EVERGREEN} AS evergreen FROM t""",
    lambda s: runs.staying_power(runs.runs(s, ["uri"], gap=RUN_GAP), ["uri"], RUN_EVERGREEN),
)
