"""Monthly tables that are folded from shared totals."""

import datetime
import os

from pyspark.sql import functions as F

from chartlake import fixtures
from chartlake.plans import gold as G
from chartlake.plans import silver as S

SF = "/root/testdata/sf0.001"


def stored_chart(spark, tmp_path):
    path = str(tmp_path / "chart")
    S.silver_chart(fixtures.chart_bronze(spark, SF).filter("year(date) = 1995"), countries=fixtures.CHART_COUNTRIES).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_artist_table_deals_the_credits_once(spark, tmp_path):
    chart = stored_chart(spark, tmp_path)
    assert plan(G.artist_performance(chart)).count("Exchange hashpartitioning") == 1
    assert plan(G.artist_performance_ranked(chart)).count("Exchange hashpartitioning") == 1
    # Credits are spread once; the country's totals come from the chart.
    assert plan(G.artist_country_dominance_deduped(chart)).count("Generate ") == 1


def test_run_gold_works_out_shared_totals_once(spark, tmp_path):
    chart = stored_chart(spark, tmp_path)
    names = [t for _, tables in G.SHARED.values() for t in tables]
    paths = G.run_gold(spark, chart, str(tmp_path / "gold"), names)
    assert sorted(os.listdir(tmp_path / "gold" / "shared")) == sorted(G.SHARED)
    for name in names:
        alone, shared = G.GOLD_TABLES[name][0](chart), spark.read.parquet(paths[name])
        assert alone.exceptAll(shared.select(*alone.columns)).isEmpty() and shared.count() == alone.count(), name


def test_a_repeated_credit_counts_by_each_tables_rule(spark):
    row = dict(
        date=datetime.date(2024, 1, 1), year=2024, month=1, country_name="X", uri="t", streams=100, rank=1,
        hit_category="Global Hit", chart_strength_score=10.5, artist_names="B|A|C", artist_uris="u|u|v",
    )
    chart = spark.createDataFrame([row, row | {"streams": 300, "chart_strength_score": 20.0, "rank": 80, "hit_category": "Popular Track"}])
    one = lambda df, c: {r.artist_uri: (r.artist_name, r[c], r.active_songs, r.hit_songs, r.avg_chart_strength) for r in df.collect()}
    assert one(G.artist_performance(chart), "total_streams") == {"u": ("A", 800, 1, 1, 15.25), "v": ("C", 400, 1, 1, 15.25)}
    assert one(G.artist_country_dominance(chart), "artist_streams") == {"u": ("A", 400, 1, 1, 15.25), "v": ("C", 400, 1, 1, 15.25)}
    assert one(G.artist_country_dominance_deduped(chart), "artist_streams") == {"u": ("A", 300, 1, 0, 20.0), "v": ("C", 300, 1, 0, 20.0)}
    assert G.artist_country_dominance(chart).agg(F.max("country_total_streams")).first()[0] == 400


def test_tables_by_month_and_country_need_no_shuffle_of_the_dealt_chart(spark, tmp_path):
    chart = stored_chart(spark, tmp_path)
    before = set(spark.catalog.listTables())
    with G.dealt_chart(chart, str(tmp_path / "dealt"), tuple(G.GOLD_TABLES)) as dealt:
        assert sorted(dealt.columns) == sorted(G.CHART_COLUMNS)
        for name in ("kpi_song", "kpi_artist", "label_performance_enhanced", "artist_performance_ranked"):
            table = G.build_table(name, chart, dealt, {})
            assert "Exchange" not in plan(table), name
            alone = G.GOLD_TABLES[name][0](chart)
            assert alone.exceptAll(table.select(*alone.columns)).isEmpty() and table.count() == alone.count(), name
        assert "Exchange" not in plan(G.place_entities(dealt)) and "Exchange" not in plan(G.artist_months(dealt, dealt=True))
    assert set(spark.catalog.listTables()) == before


def test_a_single_table_deals_the_chart_before_it_is_spread(spark, tmp_path):
    chart = stored_chart(spark, tmp_path)
    with G.dealt_chart(chart, str(tmp_path / "dealt"), ("country_performance",)) as dealt:
        steps = plan(G.build_table("country_performance", chart, dealt, {}))
    assert steps.rindex("Exchange hashpartitioning") > steps.rindex("Generate")  # the plan is printed from its end
    assert not os.path.exists(tmp_path / "dealt")
