"""Quantiles of several columns from one pass over the table."""

import pytest
from pyspark.sql import functions as F

from chartlake.operators import aggregate as A
from chartlake.plans.catalog import QUERIES


def test_one_pass_for_all_columns(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(40).select(
        (F.col("id") % 7).cast("int").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") / 4).alias("b"), (F.col("id") + (1 << 60)).alias("c")
    )
    df = rows.mapInPandas(count, rows.schema)
    got = {(r["column_name"], r["metric"]): r["value"] for r in A.exact_quartiles(df, ["a", "b", "c"]).collect()}
    assert seen.value == 40
    pdf = rows.toPandas()
    for c in ("a", "b"):
        for p in (0.25, 0.5, 0.75):
            assert got[c, f"p{round(p * 100)}"] == pytest.approx(pdf[c].dropna().quantile(p), abs=1e-4)
    counts = A.value_counts(rows, ["a", "c"])
    assert counts["c"].count() == 40 and counts["c"].agg(F.max("v")).first()[0] == (1 << 60) + 39
    assert counts["a"].schema["v"].dataType.simpleString() == "int"


@pytest.mark.parametrize("name", ["summary_with_quartiles", "approx_quantiles"])
def test_cleaned_chart_is_built_once(spark, name):
    files = QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
