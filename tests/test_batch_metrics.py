"""Metrics for tables of parameters read a stored monthly table: the chart is not built again for the parameters."""

import pytest

from chartlake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name", ["period_aggregate_batch", "series_streams_batch", "series_hit_rate_batch", "kpi_cards_batch", "top_countries_year_batch", "top_artists_batch"]
)
def test_the_chart_is_not_read_again(spark, name):
    assert not any("lineitem" in f for f in QUERIES[name](spark, SF).inputFiles())
