"""Questions and names are built from a chart that is written as it comes."""

import glob

from pyspark.sql import functions as F

from chartlake.plans import gold as G
from chartlake.plans.catalog import base, text

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_chart_is_not_dealt_out_by_month(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "stored", lambda spark, sf, name, write: write(str(tmp_path)))
    questions, countries, singers = text.asked(spark, SF)
    for name in ("silver", "artist_performance_ranked"):
        assert glob.glob(f"{tmp_path}/**/{name}/*.parquet", recursive=True) and not glob.glob(f"{tmp_path}/**/{name}/year=*", recursive=True)
    chart = base.silver(spark, SF)
    performance = G.artist_performance_ranked(chart)
    assert rows(questions.select("question_id", "text")) == rows(text.questions_of(chart, performance))
    assert rows(countries) == rows(text.country_names(chart))
    assert rows(singers) == rows(text.artist_names(performance))
    assert questions.filter(F.col("question_id").startswith("artist|")).count() > 0
