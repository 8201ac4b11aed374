"""Monthly tables built from the cleaned chart."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions import arrays, clean
from chartlake.functions.features import is_hit, percent, percent_or_zero, year_month_key, year_month_label
from chartlake.operators import rollup as R
from chartlake.operators.windows import add_growth, share_of_total
from chartlake.session import release
from chartlake.sources.writers import sink_gold_table, sink_parquet_partitioned

MONTH = ("year", "month")
PLACE = (*MONTH, "country_name")


def _artists() -> Column:
    return R.many(arrays.parts("artist_uris"))


def _track() -> Column:
    return R.one(F.col("uri"))


def _label() -> Column:
    return R.one(F.col("standardized_label"))


def _month_totals(silver: DataFrame) -> DataFrame:
    """Totals straight from the cleaned chart: two columns to read, where the entity table would be built twice."""
    return silver.groupBy(*MONTH).agg(F.sum("streams").alias("_total"))


def exclude_period(df: DataFrame, *periods: tuple[int, int]) -> DataFrame:
    """Leave out incomplete months."""
    for year, month in periods:
        df = df.filter(~((F.col("year") == year) & (F.col("month") == month)))
    return df


def kpi_song(silver: DataFrame) -> DataFrame:
    """Streams and hit flag per month, country, track and label."""
    return silver.groupBy(*PLACE, "uri", "standardized_label").agg(
        F.sum("streams").alias("total_streams"), F.max(is_hit().cast("int")).alias("is_hit")
    )


def kpi_song_rolled_up(kpi: DataFrame) -> DataFrame:
    """kpi_song without the label, for a store keyed by month, country and track."""
    return kpi.groupBy(*PLACE, "uri").agg(F.sum("total_streams").alias("total_streams"), F.max("is_hit").alias("is_hit"))


def kpi_artist(silver: DataFrame) -> DataFrame:
    """Presence: distinct artist per month and country."""
    return silver.select(*PLACE, F.explode(arrays.parts("artist_uris")).alias("artist_uri")).distinct()


def _grains() -> dict[str, Column]:
    return {
        "track": _track(),
        "artist": _artists(),
        "label": _label(),
        "song": R.one(F.when(F.col("track_name") != K.UNKNOWN_TRACK, F.col("track_name"))),
        # A credit is told apart by name and uri; one without a uri still ranks under its name.
        "credit": R.many(
            F.filter(arrays.credits(), lambda c: c["artist_name"] != K.UNKNOWN_ARTIST),
            key=lambda c: F.coalesce(c["artist_uri"], F.lit("")),
            name=lambda c: c["artist_name"],
        ),
        "credit_text": R.one(F.col("artist_names")),
        "country": R.one(F.col("country_name")),
    }


def place_entities(silver: DataFrame) -> DataFrame:
    """The totals of every entity per month and country; the tables by month or country are folded from them."""
    return R.entity_totals(silver, PLACE, _grains())


def _entities(silver: DataFrame, entities: DataFrame | None, group: Sequence[str], *kinds: str) -> DataFrame:
    """Totals per group and entity of some kinds: from place_entities where they are at hand, else from the chart."""
    if entities is None:
        grains = _grains()
        return R.entity_totals(silver, group, {k: grains[k] for k in kinds})
    own = entities.filter(F.col("kind").isin(*kinds))
    return own if tuple(group) == PLACE else R.fold_totals(own, group)


def country_performance(silver: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    table = (
        _entities(silver, entities, PLACE, "track", "artist", "song", "credit")
        .groupBy(*PLACE)
        .agg(
            R.streams_of("track").alias("total_streams"),
            R.n_of("track").alias("active_songs"),
            R.hits_of("track").alias("hit_songs"),
            R.score_of("track").alias("avg_chart_strength"),
            R.or_null(R.n_of("artist")).alias("active_artists"),
            R.top_of("song").alias("top_song_name"),
            R.top_of("credit", "name").alias("top_artist_name"),
        )
    )
    # A month holds one row per country by now, so a window is enough.
    total = F.sum("total_streams").over(Window.partitionBy(*MONTH))
    return add_growth(table.withColumn("monthly_total_streams", total), ["country_name"])


def country_performance_v2(silver: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    table = (
        _entities(silver, entities, PLACE, "track", "artist", "label", "credit_text")
        .groupBy(*PLACE)
        .agg(
            R.streams_of("track").alias("total_streams"),
            percent(R.hits_of("track"), R.n_of("track")).alias("catalog_hit_rate"),
            R.n_of("track").alias("active_songs"),
            R.or_null(R.n_of("artist")).alias("active_artists"),
            R.n_of("label").alias("active_labels"),
            R.top_of("credit_text").alias("top_artist"),
            R.top_of("label").alias("top_label"),
        )
    )
    total = F.sum("total_streams").over(Window.partitionBy(*MONTH))
    table = table.withColumn("market_share", percent(F.col("total_streams"), total))
    return add_growth(table, ["country_name"], fill=0.0).withColumn("year_month", year_month_label())


def monthly_trends(
    silver: DataFrame, excluded: Sequence[tuple[int, int]] = ((2026, 5),), entities: DataFrame | None = None
) -> DataFrame:
    if entities is not None:
        entities = exclude_period(entities, *excluded)
    table = (
        _entities(exclude_period(silver, *excluded), entities, PLACE, "track", "artist", "label")
        .groupBy(*PLACE)
        .agg(
            R.streams_of("track").alias("total_streams"),
            R.n_of("track").alias("active_songs"),
            R.n_of("label").alias("active_labels"),
            R.hits_of("track").alias("hit_songs"),
            R.score_of("track").alias("avg_chart_strength"),
            R.or_null(R.n_of("artist")).alias("active_artists"),
        )
    )
    return add_growth(table, ["country_name"])


def monthly_trends_global(silver: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    return (
        _entities(silver, entities, MONTH, "track", "artist", "label")
        .groupBy(*MONTH)
        .agg(
            R.streams_of("track").alias("total_streams"),
            R.n_of("track").alias("active_songs"),
            R.or_null(R.n_of("artist")).alias("active_artists"),
            R.n_of("label").alias("active_labels"),
        )
        .withColumn("year_month", year_month_label())
    )


def dashboard_summary(silver: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    return (
        _entities(silver, entities, MONTH, "track", "artist", "label", "country")
        .groupBy(*MONTH)
        .agg(
            R.streams_of("track").alias("total_streams"),
            R.n_of("track").alias("active_songs"),
            R.or_null(R.n_of("artist")).alias("active_artists"),
            R.n_of("label").alias("active_labels"),
            R.n_of("country").alias("countries_covered"),
            R.hits_of("track").alias("hit_songs"),
            percent(R.hits_of("track"), R.n_of("track")).alias("catalog_hit_rate"),
        )
        .withColumn("year_month", year_month_label())
    )


def label_performance_enhanced(
    silver: DataFrame, remaps: Sequence[Mapping[str, str]] = (K.LABEL_REMAP, K.LABEL_REMAP_INDIA)
) -> DataFrame:
    """Per month, country and remapped label; active_artists counts whole credit texts here."""
    mapped = silver.withColumn("standardized_label", clean.map_lookup_with_default("standardized_label", *remaps))
    group = (*PLACE, "standardized_label")
    return (
        R.entity_totals(mapped, group, {"track": _track(), "credit": R.one(F.col("artist_names"))})
        .groupBy(*group)
        .agg(
            R.streams_of("track").alias("total_streams"),
            R.n_of("track").alias("active_songs"),
            R.n_of("credit").alias("active_artists"),
        )
    )


def label_performance(silver: DataFrame) -> DataFrame:
    group = (*MONTH, "standardized_label")
    table = (
        R.entity_totals(silver, group, {"track": _track(), "artist": _artists()})
        .groupBy(*group)
        .agg(
            R.streams_of("track").alias("total_streams"),
            percent(R.hits_of("track"), R.n_of("track")).alias("catalog_hit_rate"),
            R.n_of("track").alias("active_songs"),
            R.or_null(R.n_of("artist")).alias("active_artists"),
        )
    )
    return share_of_total(table, MONTH, totals=_month_totals(silver)).withColumn("year_month", year_month_label())


def _credit_tracks(silver: DataFrame, credits: Column, group: Sequence[str], dealt: bool = False) -> DataFrame:
    """One row per group, artist and track; every credited artist gets the full measure. dealt: the chart is bucketed by the group."""
    rows = silver.select(*group, "uri", "streams", "rank", is_hit().cast("int").alias("_hit"), F.inline(credits))
    # Dealt once, for the tracks and for what is added up per artist.
    return (
        (rows if dealt else rows.repartition(*group, "artist_uri", "artist_name"))
        .groupBy(*group, "artist_uri", "artist_name", "uri")
        .agg(F.sum("streams").alias("streams"), F.sum("_hit").alias("hit_days"), F.min("rank").alias("best_rank"))
    )


def artist_months(silver: DataFrame, dealt: bool = False) -> DataFrame:
    """What the artist tables by country hold, per month, country and artist uri, from one pass over the credits.

    A track-day whose credit text names an artist twice counts twice in the plain measures and once in those ending in _once; the
    measures ending in _kept take one row per track: the one of most streams, then a hit, then the higher score. Rows are dealt by
    artist, month and country once, for both aggregates; nearly all are different tracks, so adding them up before would save nothing.
    dealt: the chart is bucketed by month and country.
    """
    score = F.col("chart_strength_score")
    parsed = silver.select(
        *PLACE, "uri", "streams", is_hit().cast("int").alias("_hit"), score.alias("_score"), arrays.named_credits().alias("_credits")
    )
    uris = F.transform("_credits", lambda c: c["artist_uri"])
    flagged = F.transform("_credits", lambda c, i: F.struct(c["artist_uri"], c["artist_name"], (F.array_position(uris, c["artist_uri"]) == i + 1).alias("_first")))
    rows = parsed.select(*PLACE, "uri", "streams", "_hit", "_score", F.inline(flagged))
    rows = rows if dealt else rows.repartition(*PLACE, "artist_uri")
    cents = R.score_cents("_score")
    once = lambda x: F.sum(F.when(F.col("_first"), x))
    tracks = rows.groupBy(*PLACE, "artist_uri", "uri").agg(
        F.min("artist_name").alias("artist_name"), F.max("_hit").alias("hit"),
        F.sum("streams").alias("streams"), F.sum(cents).alias("cents"), F.count(F.lit(1)).alias("n"),
        once(F.col("streams")).alias("streams_once"), once(cents).alias("cents_once"), F.count_if("_first").alias("n_once"),
        F.max(F.struct("streams", F.col("_hit").alias("hit"), F.col("_score").alias("score"))).alias("kept"),
    )
    return tracks.groupBy(*PLACE, "artist_uri").agg(
        F.min("artist_name").alias("artist_name"), F.count(F.lit(1)).alias("active_songs"), F.sum("hit").cast("long").alias("hit_songs"),
        F.sum("streams").alias("streams"), F.sum("cents").alias("cents"), F.sum("n").alias("n"),
        F.sum("streams_once").alias("streams_once"), F.sum("cents_once").alias("cents_once"), F.sum("n_once").alias("n_once"),
        F.sum("kept.streams").alias("streams_kept"), F.sum("kept.hit").alias("hit_songs_kept"),
        F.sum(F.round(F.col("kept.score") * 100).cast("long")).alias("cents_kept"),
    )


def artist_performance(silver: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Per month, country and artist uri; the name is the smallest one seen. months: artist_months, where it is at hand."""
    return (artist_months(silver) if months is None else months).select(
        *PLACE, "artist_uri", "artist_name", F.col("streams").alias("total_streams"), "active_songs", "hit_songs",
        R.mean_score(F.col("cents"), F.col("n")).alias("avg_chart_strength"),
    )


def artist_performance_global(silver: DataFrame) -> DataFrame:
    """Per month, artist uri and name, over all countries."""
    group = (*MONTH, "artist_uri", "artist_name")
    table = (
        R.entity_totals(
            silver.select(*PLACE, "uri", "streams", "hit_category", "chart_strength_score", F.inline(arrays.credits())).repartition(*group), group,
            {"track": _track(), "country": R.one(F.col("country_name"))},
        )
        .groupBy(*group)
        .agg(
            R.streams_of("track").alias("total_streams"),
            R.n_of("track").alias("active_songs"),
            R.n_of("country").alias("countries_reached"),
            percent(R.hits_of("track"), R.n_of("track")).alias("catalog_hit_rate"),
            R.score_of("track").alias("avg_chart_strength"),
        )
    )
    return table.withColumn("year_month", year_month_label())


def artist_performance_ranked(silver: DataFrame, dealt: bool = False) -> DataFrame:
    """Per month, country, artist uri and name; hit_track_count counts hit days, not tracks. dealt: the chart is bucketed by month and country."""
    group = (*PLACE, "artist_uri", "artist_name")
    return (
        _credit_tracks(silver, arrays.credits_tolerant(), PLACE, dealt)
        .groupBy(*group)
        .agg(
            F.sum("streams").alias("total_streams"),
            F.count(F.lit(1)).alias("track_count"),
            F.sum("hit_days").alias("hit_track_count"),
            F.min("best_rank").alias("best_rank"),
        )
        .withColumn("year_month", year_month_key())
    )


def _country_totals(silver: DataFrame) -> DataFrame:
    """Every row of the chart counts, credited or not; a few columns to read, and a row per month and country to send."""
    return silver.groupBy(*PLACE).agg(F.sum("streams").alias("country_total_streams"))


def artist_country_dominance(silver: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Each artist's share of the country's month.

    A track-day counts once per artist even if the credit text names the artist twice.
    """
    table = artist_months(silver) if months is None else months
    return table.join(_country_totals(silver), list(PLACE), "left").select(
        *PLACE, "artist_uri", "artist_name",
        F.col("streams_once").alias("artist_streams"), "country_total_streams",
        percent(F.col("streams_once"), F.col("country_total_streams")).alias("artist_market_share"),
        "active_songs", "hit_songs",
        percent(F.col("hit_songs"), F.col("active_songs")).alias("catalog_hit_rate"),
        R.mean_score(F.col("cents_once"), F.col("n_once")).alias("avg_chart_strength"),
    )


def artist_country_dominance_deduped(silver: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Each artist's share of the country's month, from one row per month, country, track and artist.

    The row kept is the one of most streams, then a hit, then the higher score. The country's total counts every row. Shares and
    rates of nothing are 0.
    """
    table = artist_months(silver) if months is None else months
    return table.join(_country_totals(silver), list(PLACE), "left").select(
        *PLACE, "artist_uri", "artist_name", F.col("streams_kept").alias("artist_streams"), "active_songs",
        F.col("hit_songs_kept").alias("hit_songs"),
        F.round(F.col("cents_kept") / F.col("active_songs") / 100, 2).alias("avg_chart_strength"), "country_total_streams",
        percent_or_zero(F.col("streams_kept"), F.col("country_total_streams")).alias("artist_market_share"),
        percent_or_zero(F.col("hit_songs_kept"), F.col("active_songs")).alias("catalog_hit_rate"),
    )


def track_catalog(silver: DataFrame) -> DataFrame:
    """One name per track: the earliest date's, then the smallest."""
    return silver.groupBy("uri").agg(F.min(F.struct("date", "track_name"))["track_name"].alias("track_name"))


SONG_CHART_COLUMNS = (
    "date", "year", "month", "quarter", "market", "country_name", "uri", "track_name", "artist_names",
    "artist_uris", "standardized_label", "rank", "peak_rank", "previous_rank", "days_on_chart",
    "consecutive_days", "streams", "hit_category", "chart_strength_score",
)


def gold_song_charts(silver: DataFrame, columns: Sequence[str] = SONG_CHART_COLUMNS) -> DataFrame:
    return silver.filter(F.col("country_name") != K.ROLLUP_COUNTRY).select(*columns)


# Table name -> (builder, partition columns, single file).
GOLD_TABLES = {
    "kpi_song": (kpi_song, MONTH, False),
    "kpi_artist": (kpi_artist, MONTH, False),
    "country_performance": (country_performance, ("year",), False),
    "monthly_trends": (monthly_trends, ("year",), False),
    "label_performance_enhanced": (label_performance_enhanced, ("year",), False),
    "artist_performance": (artist_performance, ("year",), False),
    "artist_performance_ranked": (artist_performance_ranked, ("year",), False),
    "track_catalog": (track_catalog, (), False),
    "dashboard_summary": (dashboard_summary, (), True),
    "monthly_trends_global": (monthly_trends_global, (), True),
    "country_performance_v2": (country_performance_v2, ("year",), False),
    "label_performance": (label_performance, ("year",), False),
    "artist_performance_global": (artist_performance_global, ("year",), False),
    "artist_country_dominance": (artist_country_dominance, ("year",), False),
    "artist_country_dominance_deduped": (artist_country_dominance_deduped, ("year",), False),
    "gold_song_charts": (gold_song_charts, MONTH, False),
}


#: What several tables are folded from: argument of their builders -> (builder, tables).
SHARED = {
    "entities": (place_entities, ("country_performance", "country_performance_v2", "monthly_trends", "monthly_trends_global", "dashboard_summary")),
    "months": (artist_months, ("artist_performance", "artist_country_dominance", "artist_country_dominance_deduped")),
}


#: The columns of the chart that all tables but gold_song_charts are built from.
CHART_COLUMNS = (
    "date", "year", "month", "country_name", "uri", "track_name", "artist_names", "artist_uris", "standardized_label", "rank", "streams",
    "hit_category", "chart_strength_score",
)
#: Chart rows a bucket should hold: a small chart is one bucket, so that its months aren't written in many small files.
BUCKET_ROWS = 150_000
#: Builders and shared totals that shuffle credits themselves unless they are told that the chart is dealt.
TAKE_DEALT = ("artist_performance_ranked", "months")
#: Tables whose rows come as they lie in the dealt chart, or in the cleaned one: a task holds few months, so they are written as they come.
AS_THEY_COME = (
    "kpi_song", "kpi_artist", "label_performance_enhanced", "artist_performance", "artist_performance_ranked", "artist_country_dominance",
    "artist_country_dominance_deduped", "gold_song_charts",
)


@contextmanager
def dealt_chart(silver: DataFrame, path: str, tables: Collection[str]) -> Iterator[DataFrame]:
    """The chart dealt by month and country, by which most tables group: its rows are shuffled once, before anything is spread.

    It is written in buckets, of one month's country each, and read by all tables; a single table takes it without its being written.
    """
    spark, chart = silver.sparkSession, silver.select(*(c for c in CHART_COLUMNS if c in silver.columns))
    if len(tables) == 1:
        yield chart.repartition(*PLACE)
        return
    buckets = max(1, -(-chart.count() // BUCKET_ROWS))
    name = f"dealt_chart_{uuid.uuid4().hex}"
    chart.repartition(buckets, *PLACE).write.mode("overwrite").bucketBy(buckets, *PLACE).option("path", path).saveAsTable(name)
    release(spark)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def build_table(name: str, silver: DataFrame, chart: DataFrame, options: Mapping[str, object]) -> DataFrame:
    """A gold table from the dealt chart, or from the cleaned one where it takes more columns."""
    dealt = {"dealt": True} if name in TAKE_DEALT else {}
    return GOLD_TABLES[name][0](silver if name == "gold_song_charts" else chart, **dealt, **options)


def shared_arguments(silver: DataFrame, tables: Collection[str], out: str) -> dict[str, dict[str, DataFrame]]:
    """Table -> what its builder takes besides the chart; worked out once and written below out where two tables or more ask for it.

    silver is the dealt chart.
    """
    found: dict[str, dict[str, DataFrame]] = {}
    for name, (build, users) in SHARED.items():
        asked = [t for t in users if t in tables]
        if len(asked) > 1:
            df = build(silver, **({"dealt": True} if name in TAKE_DEALT else {}))
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            read = silver.sparkSession.read.schema(df.schema).parquet(f"{out}/{name}")
            del df
            release(silver.sparkSession)
            found |= {t: {name: read} for t in asked}
    return found


def run_gold(
    spark: SparkSession,
    silver: DataFrame,
    out: str,
    tables: Collection[str] = tuple(GOLD_TABLES),
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, str]:
    """Write the cleaned chart once, deal it, then write what several requested tables share, then every requested table from these.

    Shuffle files go as soon as what they were for is written. options: table name -> arguments of its builder, such as the months a
    trend leaves out.
    """
    paths = {"silver": f"{out}/silver"}
    sink_parquet_partitioned(silver, paths["silver"], MONTH)
    release(spark)
    source = spark.read.parquet(paths["silver"])
    with dealt_chart(source, f"{out}/dealt", tables) as chart:
        shared = shared_arguments(chart, tables, f"{out}/shared")
        for name in tables:
            _, partition_by, single_file = GOLD_TABLES[name]
            paths[name] = f"{out}/{name}"
            table = build_table(name, source, chart, {**(options or {}).get(name, {}), **shared.get(name, {})})
            if name in AS_THEY_COME:
                table.write.mode("overwrite").partitionBy(*partition_by).parquet(paths[name])
                continue
            sink_gold_table(table, paths[name], partition_by, single_file)
            del table
            release(spark)
    return paths
