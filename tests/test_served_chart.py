"""The retrieval queries' monthly tables from a chart bucketed by month and country: no shuffle of its rows, the same tables."""

from chartlake.plans import gold as G
from chartlake.plans.catalog import retrieval as Q
from chartlake.plans.catalog.base import silver

SF = "/root/testdata/sf0.001"


def test_tables_group_the_bucketed_chart_without_a_shuffle(spark, tmp_path):
    chart = silver(spark, SF)
    chart.select(*Q.CHART_COLUMNS).repartition(8, *G.PLACE).write.bucketBy(8, *G.PLACE).option("path", f"{tmp_path}/chart").saveAsTable("dealt_chart")
    built = Q._of_dealt_chart(spark.table("dealt_chart"))
    plans = {t: df._jdf.queryExecution().executedPlan().toString() for t, df in built.items()}
    for table in ("kpi_song", "label_performance_enhanced", "artist_performance_ranked"):
        assert "Exchange" not in plans[table], table
    # The windows over months and over countries take a row per month and country each.
    assert plans["country_performance"].rindex("Exchange") < plans["country_performance"].index("Generate")
    for table, df in built.items():
        plain = G.GOLD_TABLES[table][0](chart)
        assert df.columns == plain.columns and df.exceptAll(plain).count() == 0 and plain.exceptAll(df).count() == 0, table
