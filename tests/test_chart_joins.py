"""The chart's joins on Spark: the rows of CHART_SQL, with the tracks joined last and by uri, so that grouping by uri and more costs no shuffle."""

from chartlake import fixtures
from chartlake.operators import dedupe

SF = "/root/testdata/sf0.001"


def test_rows_are_those_of_the_sql(spark):
    sides = {n: fixtures.table(spark, SF, n) for n in ("lineitem", "orders", "customer", "nation", "part")}
    plain, built = spark.sql(fixtures.CHART_SQL, **sides), fixtures.chart_bronze(spark, SF)
    assert plain.schema.simpleString() == built.schema.simpleString()
    assert plain.exceptAll(built).count() == 0 and built.exceptAll(plain).count() == 0


def test_dedupe_shuffles_no_chart_rows_again(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # Joins shuffle both sides: line items and orders by order, orders and customers by customer, nations, tracks by uri.
        for df in (dedupe.dedupe_full_row(fixtures.chart_bronze(spark, SF)), dedupe.dedupe_business_key(fixtures.chart_bronze(spark, SF))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            top = plan[: plan.index("SortMergeJoin")]
            assert "Exchange" not in top and ("HashAggregate" in top or "Window" in top)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
