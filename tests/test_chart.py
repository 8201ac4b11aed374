"""Edge rows of the cleaned chart and the monthly tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions import arrays, clean, features
from chartlake.operators import rollup as R
from chartlake.operators import windows
from chartlake.plans import gold as G
from chartlake.plans import silver as S
from chartlake.plans.catalog import base
from chartlake.sources import readers, writers

SCHEMA = (
    "date date, country string, rank int, uri string, artist_names string, track_name string, label string, peak_rank int, "
    "previous_rank int, days_on_chart int, streams bigint, consecutive_days int, artist_uris string, release_date date"
)
SF = "/root/testdata/sf0.001"


def row(day="2024-01-05", country="de", rank=5, uri="t:1", names="A|B", track="Song", label="Some LABEL ", peak=3,
        previous=7, days=10, streams=100, consecutive=4, uris="a:1|a:2", release="2023-01-01"):
    date = dt.date.fromisoformat
    return (date(day), country, rank, uri, names, track, label, peak, previous, days, streams, consecutive, uris,
            date(release) if release else None)


@pytest.fixture
def chart(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def test_dedupe_keeps_the_most_streams_then_the_smallest_rest(chart):
    out = S.silver_chart(chart(row(streams=5, track="x"), row(streams=9, track="z"), row(streams=9, track="y"))).collect()
    assert [(r.streams, r.track_name) for r in out] == [(9, "y")]


def test_rollup_and_unmapped_markets_are_dropped_unless_kept(chart):
    rows = chart(row(), row(country="global"), row(country="xx"))
    assert [r.market for r in S.silver_chart(rows).collect()] == ["de"]
    assert S.silver_chart(rows, drop_rollup=None).count() == 3


def test_defaults_then_trim_then_standardize(chart):
    out = S.silver_chart(chart(row(names=None, track=None, label=None), row(uri="t:2", label="  the WEEKND/lyric co "))).orderBy("uri").collect()
    assert (out[0].artist_names, out[0].track_name, out[0].standardized_label) == ("Unknown Artist", "Unknown Track", "Independent")
    assert out[1].standardized_label == "The Weeknd/lyric Co"


@pytest.mark.parametrize(
    "rank, label",
    [(10, "Global Hit"), (11, "Major Hit"), (50, "Major Hit"), (51, "Popular Track"), (100, "Popular Track"), (101, "Charting Track")],
)
def test_hit_bands(chart, rank, label):
    assert S.silver_chart(chart(row(rank=rank))).first().hit_category == label


def test_score(chart):
    out = S.silver_chart(chart(row(rank=1, peak=1, days=10, consecutive=5))).first()
    assert out.chart_strength_score == round(200 * 0.4 + 200 * 0.3 + 2 + 0.5, 2)


def test_normalized_score_reaches_100(chart):
    out = S.silver_chart_rich(chart(row(rank=1, peak=1, days=10, consecutive=4), row(uri="t:2", rank=200, peak=200, days=5, consecutive=2)))
    assert [r.chart_strength_score for r in out.orderBy("uri").collect()] == [100.0, 15.35]


@pytest.mark.parametrize(
    "age, label",
    [(90, "New Release"), (91, "Recent Hit"), (365, "Recent Hit"), (366, "Established"), (1825, "Established"), (1826, "Evergreen"), (-1, "Unknown")],
)
def test_age_bands(chart, age, label):
    released = (dt.date(2024, 1, 5) - dt.timedelta(days=age)).isoformat()
    assert S.silver_chart_rich(chart(row(release=released))).first().song_age_category == label


@pytest.mark.parametrize(
    "move, v1, v2",
    [(50, "Strong Gainer", "Strong Gainer"), (5, "Gainer", "Gainer"), (4, "Gainer", "Stable"), (0, "Stable", "Stable"),
     (-4, "Decliner", "Stable"), (-5, "Decliner", "Decliner"), (-50, "Strong Decliner", "Strong Decliner"), (None, "New Entry", "New Entry")],
)
def test_movement_bands(chart, move, v1, v2):
    df = chart(row(rank=60, previous=-1 if move is None else 60 + move)).withColumn("rank_movement", features.rank_movement())
    out = df.select(features.movement_category_v1().alias("a"), features.movement_category_v2().alias("b")).first()
    assert (out.a, out.b) == (v1, v2)


def test_credits(chart):
    df = chart(
        row(uri="1", names="A|B|C", uris="u1|u2"), row(uri="2", names="Name | Pipe", uris="u3"), row(uri="3", names="A||B", uris="u4||u5"),
        row(uri="4", names="Unknown Artist", uris="u6"),
    )
    pairs = lambda expr: {r.uri: [tuple(c) for c in r.c] for r in df.select("uri", expr.alias("c")).collect()}
    assert pairs(arrays.credits())["1"] == [("u1", "A"), ("u2", "B"), (None, "C")]
    named = pairs(arrays.named_credits())
    assert named["1"] == [("u1", "A"), ("u2", "B")] and named["3"] == [("u4", "A"), ("u5", "B")] and named["4"] == []
    tolerant = pairs(arrays.credits_tolerant())
    assert tolerant["2"] == [("u3", "Name | Pipe")]
    assert tolerant["1"] == [("u1", "A|B|C"), ("u2", "A|B|C")]
    assert [r.p for r in df.orderBy("uri").select(arrays.parts("artist_uris").alias("p")).collect()][2] == ["u4", "u5"]


def test_remap_matches_keys_after_standardizing(spark):
    df = spark.createDataFrame([("The Weeknd/lyric",), ("Shubh",), ("Karan Aujla",), ("Other",)], "l string")
    out = [r.x for r in df.select(clean.map_lookup_with_default("l", K.LABEL_REMAP, K.LABEL_REMAP_INDIA).alias("x")).collect()]
    assert out == ["Xo / Republic Records", "Warner Music India", "Rehaan Records", "Other"]


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "country_name string, year int, month int, total_streams bigint")


def test_growth_over_gap_zero_and_single_month(spark):
    df = months(spark, ("A", 2024, 1, 0), ("A", 2024, 2, 10), ("A", 2024, 4, 15), ("B", 2024, 1, 7))
    out = {(r.country_name, r.month): r.growth_percentage for r in windows.add_growth(df, ["country_name"]).collect()}
    assert out == {("A", 1): None, ("A", 2): None, ("A", 4): 50.0, ("B", 1): None}
    strict = windows.add_growth(df, ["country_name"], calendar=True).filter("month = 4").first()
    assert strict.growth_percentage is None
    assert windows.add_growth(df, ["country_name"], fill=0.0).filter("growth_percentage is null").count() == 0


def test_growth_year_change_counts_as_neighbouring(spark):
    df = months(spark, ("A", 2023, 12, 10), ("A", 2024, 1, 20))
    assert windows.add_growth(df, ["country_name"], calendar=True).filter("year = 2024").first().growth_percentage == 100.0


def test_top_names_break_ties_by_name(chart):
    out = G.country_performance(
        S.silver_chart(chart(row(uri="1", track="b", names="Y", uris="u1"), row(uri="2", track="a", names="X", uris="u2"), row(uri="3", track=None, names=None, streams=999)))
    ).first()
    assert (out.top_song_name, out.top_artist_name, out.active_songs) == ("a", "X", 3)


def test_song_under_two_labels_keeps_both_rows_until_rolled_up(chart):
    silver = S.silver_chart(chart(row(label="a"), row(day="2024-01-06", label="b", rank=100)))
    kpi = G.kpi_song(silver)
    assert kpi.count() == 2
    assert [(r.total_streams, r.is_hit) for r in G.kpi_song_rolled_up(kpi).collect()] == [(200, 1)]


def test_no_artist_uri_leaves_no_active_artists(chart):
    assert G.country_performance(S.silver_chart(chart(row(uris=None)))).first().active_artists is None


def test_dominance_counts_a_track_day_once_per_artist(chart):
    silver = S.silver_chart(chart(row(names="A|A", uris="u|u"), row(uri="t:2", names="B", uris="v", streams=300)))
    shares = {r.artist_uri: r.artist_market_share for r in G.artist_country_dominance(silver).collect()}
    assert shares == {"u": 25.0, "v": 75.0}


def test_invariants(spark):
    silver = base.silver(spark, SF)
    table = G.country_performance_v2(silver)
    off = table.groupBy("year", "month").agg(F.sum("market_share").alias("s"), F.count(F.lit(1)).alias("n"))
    assert off.filter("abs(s - 100) > 0.005 * n + 1e-9").count() == 0
    assert G.artist_performance(silver).filter("hit_songs > active_songs").count() == 0
    keys = ["year", "month", "country_name", "uri", "standardized_label"]
    kpi = G.kpi_song(silver)
    assert kpi.count() == kpi.select(*keys).distinct().count()
    assert kpi.agg(F.sum("total_streams")).first()[0] == silver.agg(F.sum("streams")).first()[0]


def test_exploded_totals_equal_credits_times_streams(spark):
    bronze = base.bronze(spark, SF).filter("artist_names is not null")
    credits = arrays.credits_tolerant()
    exploded = bronze.select("streams", F.explode(credits)).agg(F.sum("streams")).first()[0]
    assert exploded == bronze.agg(F.sum(F.col("streams") * F.size(credits))).first()[0]


def test_mean_score_does_not_depend_on_partitioning(spark):
    df = base.silver(spark, SF).select("country_name", R.score_cents().alias("c")).cache()
    agg = lambda d: d.groupBy("country_name").agg(R.mean_score(F.sum("c"), F.count(F.lit(1))).alias("m")).orderBy("country_name").collect()
    assert agg(df) == agg(df.repartition(13))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1, "a", 1), (2024, 1, "a", 2), (2024, 12, "b", 3)], "year int, month int, k string, v int")
    path = str(tmp_path / "t")
    counts = writers.reload_first_wins(df, path, ["year", "month", "k"], ["v"], ["year", "month"])
    assert counts == {"rows_read": 3, "rows_loaded": 2, "rows_skipped": 1}
    back = readers.scan_hive_partitioned(spark, path)
    assert sorted((r.year_month, r.v) for r in back.collect()) == [("2024-01", 1), ("2024-12", 3)]
    check = writers.readback_check(spark, path, ["year", "month"]).first()
    assert (check.row_count, check.column_count, check.partition_count) == (2, 4, 2)
    single = str(tmp_path / "s")
    writers.sink_gold_table(df, single, single_file=True)
    assert len(list((tmp_path / "s").glob("part-*"))) == 1
    one = readers.scan_hive_partitioned(spark, single, levels=0)
    assert "year_month" not in one.columns


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError):
        readers.require_rows(spark.range(0), "nothing")


def test_csv_with_schema_and_source_schemas(spark, tmp_path):
    for name, schema in readers.SOURCE_SCHEMAS.items():
        empty = spark.createDataFrame([], schema)
        path = str(tmp_path / name)
        empty.write.csv(path, header=True)
        assert readers.scan_csv_schema(spark, path, schema).columns == empty.columns


def test_case_variants_ignore_outer_blanks(spark):
    from chartlake.operators import quality

    rows = spark.createDataFrame([("Sony",), (" SONY ",), ("Warner",), (None,)], "label string")
    assert [tuple(r) for r in quality.case_variants(rows, "label").collect()] == [("sony", 2, 2)]
