"""Runs on the chart against a plain scan."""

import datetime
import random

import pytest

from chartlake.operators import runs as R

START = datetime.date(2020, 1, 1)


def plain(rows, gap):
    out = []
    for key in {k for k, _, _ in rows}:
        days = sorted({d for k, d, _ in rows if k == key and d is not None})
        run = []
        for d in [*days, None]:
            if run and (d is None or (d - run[-1]).days > gap + 1):
                out.append((key, run[0], run[-1], len(run), sum(s for k, e, s in rows if k == key and e in run)))
                run = []
            run.append(d)
    return sorted(out)


def sample():
    rnd = random.Random(3)
    rows = [("hot", START + datetime.timedelta(days=k), k) for k in range(900) if k not in (300, 301, 500)]
    rows += [(f"t{rnd.randrange(5)}", START + datetime.timedelta(days=rnd.randrange(400)), rnd.randrange(50)) for _ in range(600)]
    return rows + [("once", START, 1), ("once", START, 2), ("none", None, 3)]


@pytest.mark.parametrize("gap", [0, 1, 2])
@pytest.mark.parametrize("block_days", [1, 7, 366])
def test_runs(spark, gap, block_days):
    df = spark.createDataFrame(sample(), "uri string, date date, streams long").repartition(4)
    got = sorted(tuple(r) for r in R.runs(df, ["uri"], gap=gap, block_days=block_days).collect())
    assert got == plain(sample(), gap)


def test_staying_power(spark):
    df = spark.createDataFrame(sample(), "uri string, date date, streams long")
    rows = {r["uri"]: r for r in R.staying_power(R.runs(df, ["uri"]), ["uri"], 300).collect()}
    hot = rows["hot"]
    assert (hot["runs"], hot["longevity"], hot["longest_run"], hot["span_days"], hot["evergreen"]) == (3, 897, 399, 900, True)
    assert hot["sustainability"] == 99.67 and rows["once"]["sustainability"] == 100.0 and not rows["once"]["evergreen"] and "none" not in rows
    assert R.runs(df.filter("false"), ["uri"]).count() == 0
