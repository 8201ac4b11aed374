"""Batch answers on small tables."""

import pytest
from pyspark.sql import functions as F

from chartlake.operators import answers as A
from chartlake.operators import turns as T

COUNTRIES = [("Brazil", 2020, 10), ("Brazil", 2021, 40), ("India", 2020, 30), ("India", 2021, 20), ("Chad", 2021, 5)]
SONGS = [("s1", 2020, 1, 1), ("s1", 2021, 1, 1), ("s2", 2021, 9, 0), ("s3", 2021, 7, 1)]
ARTISTS = [("u1", "The Acme Band", 2020, 3), ("u1", "The Acme Band", 2021, 4), ("u2", "Other", 2021, 50)]
#: question, mentions, rows of (position, key, value), table
CASES = [
    ("How many total streams does Brazil have", [("country_performance", "Brazil")], [(1, None, 50)], "country_performance"),
    ("How many total streams does The Acme Band have", [("artist_performance", "u1")], [(1, None, 7)], "artist_performance"),
    ("how many streams in total in 2021", [], [(1, None, 65)], "country_performance"),
    ("how many streams in total in 2031", [], [(1, None, 0)], "country_performance"),
    ("how many countries are there", [], [(1, None, 3)], "country_performance"),
    ("how many hit songs in 2021", [], [(1, None, 2)], "kpi_song"),
    ("how many hit songs", [], [(1, None, 2)], "kpi_song"),
    ("which country had the lowest numbers", [], [(1, "Chad", 5), (2, "Brazil", 50)], "country_performance"),
    ("which country is best", [("country_performance", "India")], [(1, "Brazil", 50), (2, "India", 50)], "country_performance"),
    ("best country of Chad and India", [("country_performance", x) for x in ("Chad", "India")], [(1, "India", 50), (2, "Chad", 5)], "country_performance"),
    ("which country grew in 2021", [], [(1, "Brazil", 30), (2, "Chad", 5)], "country_performance"),
    ("which country grew least in 2020 or 2021", [], [(1, "India", -10), (2, "Chad", 5)], "country_performance"),
    ("which country grew in 2020, Chad or India", [("country_performance", x) for x in ("Chad", "India")], [(1, "India", 30)], "country_performance"),
    ("tell me something", [], [], None),
]


@pytest.fixture(scope="module")
def found(spark):
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    facts = A.yearly_facts(
        {
            "country_performance": (table(COUNTRIES, "k string, year int, total_streams long"), "k", F.col("k"), F.lit(0)),
            "artist_performance": (table(ARTISTS, "k string, n string, year int, total_streams long"), "k", F.col("n"), F.lit(0)),
            "kpi_song": (table(SONGS, "k string, year int, total_streams long, is_hit int"), "k", F.col("k"), F.col("is_hit")),
        }
    )
    questions = table([(str(i), c[0]) for i, c in enumerate(CASES)], "question_id string, text string")
    mentions = table([(str(i), t, k) for i, c in enumerate(CASES) for t, k in c[1]], "question_id string, source_table string, key string")
    return A.answers(A.named_targets(T.label_turns(questions), mentions), mentions, facts, k=2).collect()


@pytest.mark.parametrize("at", range(len(CASES)))
def test_answer(found, at):
    rows = [r for r in found if r.question_id == str(at)]
    assert sorted(((r.position, r.key, r.value) for r in rows), key=lambda r: r[0]) == CASES[at][2]
    assert {r.source_table for r in rows} <= {CASES[at][3]}
