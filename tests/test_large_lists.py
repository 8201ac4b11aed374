"""Steps whose work would grow faster than the input: names for an automaton, keys of spelt names, texts of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from chartlake.operators import entities as E
from chartlake.operators import retrieval as R

NAMES = ["Taylor Swift", "TAYLOR SWIFT", "Act 123456", "Act 123457", "India"]


@pytest.fixture
def names(spark):
    return E.name_dictionary(spark.createDataFrame([(n,) for n in NAMES], "name string"), "name")


def test_too_many_names_are_found_by_runs(spark, names, monkeypatch):
    texts = spark.createDataFrame([(1, "what about Act 123456?"), (2, "nothing")], "id int, text string")
    want = [(1, "Act 123456")]
    found = lambda: [(r.id, r.entity) for r in E.detect_entities(texts, ["id"], "text", names, by_runs=None).collect()]
    assert found() == want
    monkeypatch.setattr(E, "DICTIONARY_CHARS", 10)
    assert found() == want
    routed = E.route_table(texts, ["id"], "text", names.filter("entity = 'India'"), names.filter("entity <> 'India'"))
    assert {r.id: r.source_table for r in routed.collect()} == {1: "artist_performance", 2: None}


def test_keys_are_made_only_for_questions_without_a_spelt_name(spark, names, monkeypatch):
    rows = [(1, "about taylor swift"), (2, "about act 12345"), (None, "act 123457 now"), (3, "nothing"), (4, "TAYLR SWIFT or act 123456")]
    questions = spark.createDataFrame(rows, "id int, text string")
    asked, plain = [], E.similar_names

    def similar_names(grams, *more):
        asked.extend({r.gram for r in grams.collect()})
        return plain(grams, *more)

    monkeypatch.setattr(E, "similar_names", similar_names)
    got = {r.id: (r.entity, round(r.score, 3)) for r in E.fuzzy_match(questions, ["id"], "text", names).collect()}
    assert got == {1: ("TAYLOR SWIFT", 100.0), 2: ("Act 123456", round(1800 / 19, 3)), None: ("Act 123457", 100.0), 4: ("Act 123456", 100.0)}
    assert "act 12345" in asked and not {"taylor swift", "act 123457", "act 123456", "taylr swift"} & set(asked)


def test_reranking_within_entities_shuffles_no_pairs(spark, tmp_path):
    rng = random.Random(5)
    said = lambda: " ".join(rng.choices(["a", "b", "c", "d"], k=4))
    chunks = spark.createDataFrame([("t", f"e{i % 6}|{i}", f"e{i % 6}", said()) for i in range(60)], "source_table string, source_key string, entity string, chunk_text string")
    asked = spark.createDataFrame([(f"q{i}", "t", f"e{i % 7}", said() if i else None) for i in range(20)], "query_id string, source_table string, entity string, text string")
    pairs = asked.join(chunks, ["source_table", "entity"]).select("query_id", "source_table", "source_key")
    plain = R.rerank_pairs(pairs, asked, chunks, 3)
    within = R.rerank_pairs(None, asked, chunks, 3, within=["source_table", "entity"])
    assert sorted(map(tuple, within.collect())) == sorted(map(tuple, plain.collect())) and within.columns == plain.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = R.rerank_pairs(None, asked, chunks, 3, within=["source_table", "entity"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
