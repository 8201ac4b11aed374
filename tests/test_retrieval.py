"""Nearest neighbours, keyword search, fusion and gating against brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions.vectors import embed, hashed_counts, pair_scores
from chartlake.operators import aggregate
from chartlake.operators import retrieval as R
from chartlake.streaming import usage as U


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    corpus = rng.integers(-3, 4, size=(300, 6)).astype("float32")
    corpus[50:150] = corpus[0]  # a third of the rows are copies of one
    queries = rng.integers(-3, 4, size=(40, 6)).astype("float32")
    queries[0] = corpus[0]
    c = spark.createDataFrame([("t", f"k{i:03d}", v.tolist(), f"s{i % 3}") for i, v in enumerate(corpus)],
                              "source_table string, source_key string, embedding array<float>, scope string").repartition(5)
    q = spark.createDataFrame([(f"q{i}", v.tolist(), f"s{i % 4}" if i % 2 else None) for i, v in enumerate(queries)],
                              "query_id string, embedding array<float>, scope string")
    return corpus, queries, c, q


def nearest(corpus, query, k, scope=None):
    d = np.round(np.sqrt(((corpus.astype(float) - query.astype(float)) ** 2).sum(axis=1)), 6)
    rows = [i for i in range(len(corpus)) if scope is None or f"s{i % 3}" == scope]
    return [(f"k{i:03d}", d[i]) for i in sorted(rows, key=lambda i: (d[i], i))[:k]]


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.source_key, r.distance))
    return out


@pytest.mark.parametrize("blocks", [{}, {"in_blocks": True, "query_block": 7, "corpus_block": 31}])
@pytest.mark.parametrize("scoped", [False, True])
def test_knn_exact_both_ways(points, blocks, scoped):
    corpus, queries, c, q = points
    got = by_query(R.knn_exact(c, q if scoped else q.drop("scope"), 7, **blocks))
    want = {}
    for i, v in enumerate(queries):
        found = nearest(corpus, v, 7, f"s{i % 4}" if scoped and i % 2 else None)
        if found:
            want[f"q{i}"] = found
    assert got == want


def test_knn_without_queries(points):
    _, _, c, q = points
    assert R.knn_exact(c, q.filter("false"), 3).count() == 0


def test_too_many_queries_to_broadcast(points, monkeypatch):
    monkeypatch.setattr(R, "QUERY_BYTES", 10)
    with pytest.raises(ValueError, match="in_blocks"):
        R.knn_exact(points[2], points[3], 3)


@pytest.mark.parametrize("scoped", [False, True])
def test_many_queries_go_to_blocks(points, monkeypatch, scoped):
    _, _, c, q = points
    asked = q if scoped else q.drop("scope")
    want = by_query(R.knn_exact(c, asked, 7))
    monkeypatch.setattr(R, "QUERY_BYTES", 10)
    assert by_query(R.knn_exact(c, asked, 7, in_blocks=None, query_block=7, corpus_block=31)) == want
    monkeypatch.setattr(R, "QUERY_BYTES", 20 * 6 * 8)  # the queries without a scope fit, all of them don't
    assert by_query(R.knn_exact(c, asked, 7, in_blocks=None, query_block=7, corpus_block=31)) == want


def test_equal_distances_from_the_product(points, monkeypatch):
    corpus, queries, _, _ = points
    import pandas as pd

    asked = pd.DataFrame({"query_id": [f"q{i}" for i in range(len(queries))]})
    rows = pd.DataFrame({"source_key": [f"k{i:03d}" for i in range(len(corpus))]}).iloc[::-1].reset_index(drop=True)
    monkeypatch.setattr(R.Nearest, "PAIRS", 3)
    found = R.Nearest(asked, queries.astype(float) / 7, ["source_key"], 7)
    found.add(rows, corpus[::-1].astype(float) / 7)
    got = found.result()
    for i, v in enumerate(queries):
        own = got[got["query_id"] == f"q{i}"]
        assert list(zip(own["source_key"], own["distance"])) == nearest(corpus.astype(float) / 7, v.astype(float) / 7, 7)


def test_hybrid_and_entities_with_many_queries(spark, monkeypatch):
    texts = [("t", f"e{i % 4}|{2000 + i // 4}", f"entity e{i % 4} had {i} streams in {2000 + i // 4}") for i in range(24)]
    chunks = spark.createDataFrame(texts, "source_table string, source_key string, chunk_text string")
    chunks = chunks.withColumn("embedding", embed(F.col("chunk_text"), hashed_counts(16))).withColumn("scope", F.col("source_table"))
    asked = spark.createDataFrame([(f"q{i}", f"streams of e{i % 4}", "t" if i % 2 else None) for i in range(12)], "query_id string, text string, scope string")
    asked = asked.withColumn("embedding", embed(F.col("text"), hashed_counts(16)))
    named = spark.createDataFrame([(f"q{i}", "t", f"e{i % 4}") for i in range(12)], "query_id string, source_table string, key string")

    def both():
        return [sorted(map(tuple, df.collect())) for df in (R.hybrid_search(chunks, asked, 3), R.retrieve_per_entity(chunks, asked, named, 2))]

    want = both()
    monkeypatch.setattr(R, "QUERY_BYTES", 10)
    assert both() == want and all(want)


CHUNKS = {
    "a": "Label Warner had 10 total streams",
    "b": "Track one on label Sony had many streams",
    "c": "Countries and country charts: total chart streams of India",
    "d": "India, India and streaming totals",
}
SEARCHES = {
    "streams": {"a", "b", "c"},
    "the total streams": {"a", "c"},
    '"total streams"': {"a"},
    "streams -label": {"c"},
    "india or warner": {"a", "c", "d"},
    '"india or warner" streams': set(),
    'streams -"total streams"': {"b", "c"},
    "country": {"c"},
    "nowhere streams": set(),
    "the of and": set(),
    "-label": set(),
}


@pytest.mark.parametrize("text", SEARCHES)
def test_keyword_matches(spark, text):
    corpus = spark.createDataFrame([("t", k, v) for k, v in CHUNKS.items()], "source_table string, source_key string, chunk_text string")
    asked = spark.createDataFrame([("q", text)], "query_id string, text string")
    assert {r.source_key for r in R.keyword_search(corpus, asked, 10).collect()} == SEARCHES[text]


def test_keyword_score_and_order(spark):
    corpus = spark.createDataFrame([("t", k, v) for k, v in CHUNKS.items()], "source_table string, source_key string, chunk_text string")
    asked = spark.createDataFrame([("q", "india")], "query_id string, text string")
    out = [(r.source_key, r.score) for r in R.keyword_search(corpus, asked, 10).orderBy("rank").collect()]
    terms = {k: [w for w in re.findall(r"\w+", v.lower()) if w not in K.STOP_WORDS] for k, v in CHUNKS.items()}
    mean = sum(map(len, terms.values())) / 4
    idf = math.log(1 + (4 - 2 + 0.5) / 2.5)
    score = {k: round(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(terms[k]) / mean)), 6) for k, tf in (("c", 1), ("d", 2))}
    assert out == [("d", score["d"]), ("c", score["c"])]


def test_keyword_scope(spark):
    corpus = spark.createDataFrame([(f"t{i % 2}", str(i), "same words") for i in range(6)], "source_table string, source_key string, chunk_text string")
    asked = spark.createDataFrame([("q", "words", "t1"), ("r", "words", None)], "query_id string, text string, scope string")
    out = R.keyword_search(corpus.withColumn("scope", F.col("source_table")), asked, 10)
    assert {(r.query_id, r.source_key) for r in out.collect()} == {("q", "1"), ("q", "3"), ("q", "5")} | {("r", str(i)) for i in range(6)}


def test_rrf_counts_a_chunk_in_one_list(spark):
    schema = "query_id string, source_table string, source_key string, rank int"
    a = spark.createDataFrame([("q", "t", "x", 0), ("q", "t", "y", 1)], schema)
    b = spark.createDataFrame([("q", "t", "y", 0), ("q", "t", "z", 5)], schema)
    out = {r.source_key: round(r.rrf_score, 9) for r in R.rrf_merge(a, b).collect()}
    assert out == {"x": round(1 / 60, 9), "y": round(1 / 61 + 1 / 60, 9), "z": round(1 / 65, 9)}


def test_gate(spark):
    routed = spark.createDataFrame(
        [("far", None, False), ("near", None, False), ("none", "t", False), ("sure", "t", True), ("edge", None, False)],
        "query_id string, source_table string, confident boolean")
    top1 = spark.createDataFrame([("far", 0.951), ("near", 0.949), ("sure", 1.2), ("edge", 0.95)], "query_id string, distance double")
    out = {r.query_id: r.outcome for r in R.confidence_gate(routed, top1).collect()}
    assert out == {"far": "no data", "near": "answer", "none": "no data", "sure": "answer", "edge": "answer"}


def test_hybrid_and_pluggable_models(spark):
    corpus = spark.createDataFrame([("t", k, v) for k, v in CHUNKS.items()], "source_table string, source_key string, chunk_text string").withColumn(
        "embedding", embed(F.col("chunk_text"), hashed_counts(32), batch=2))
    asked = spark.createDataFrame([("q", "India totals")], "query_id string, text string").withColumn("embedding", embed(F.col("text"), hashed_counts(32)))
    best = R.hybrid_search(corpus, asked, k=2).orderBy("rank").collect()
    assert best[0].source_key == "d" and len(best) == 2

    def load():
        return lambda questions, chunks: [len(c) for c in chunks]

    longest = R.hybrid_search(corpus, asked, k=1, score=lambda q, c: pair_scores(q, c, load)).first()
    assert longest.source_key == "c"


def test_embedding_is_unit_length_or_zero(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,)], "t string").select(embed(F.col("t"), hashed_counts(16)).alias("v"))
    norms = sorted(round(float(np.linalg.norm(r.v)), 6) for r in df.collect())
    assert norms == [0.0, 0.0, 1.0]


def test_entities_do_not_crowd_each_other_out(spark):
    corpus = spark.createDataFrame(
        [("c", f"India|{y}", [0.0, float(y - 2000)]) for y in range(2000, 2010)] + [("c", f"Brazil|{y}", [9.0, float(y - 2000)]) for y in range(2000, 2002)],
        "source_table string, source_key string, embedding array<float>")
    asked = spark.createDataFrame([("q", [0.0, 0.0])], "query_id string, embedding array<float>")
    mentions = spark.createDataFrame([("q", "c", "India"), ("q", "c", "Brazil")], "query_id string, source_table string, key string")
    out = R.retrieve_per_entity(corpus, asked, mentions, 3).collect()
    assert sorted((r.entity_key, r.rank, r.source_key) for r in out) == [
        ("Brazil", 0, "Brazil|2000"), ("Brazil", 1, "Brazil|2001"), ("India", 0, "India|2000"), ("India", 1, "India|2001"), ("India", 2, "India|2002")]


def test_compare_runs(spark):
    schema = "query_id string, source_table string, top_chunks string, outcome string"
    before = spark.createDataFrame([("a", "t", "x", "answer"), ("b", None, "y", "no data")], schema)
    after = spark.createDataFrame([("a", "t", "x", "answer"), ("b", None, "y", "answer"), ("c", "t", "z", "answer")], schema)
    assert {r.query_id: r.changed for r in R.compare_runs(before, after).collect()} == {"a": False, "b": True, "c": True}


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [5.0] * 40 + [1.0, 9.0], list(np.random.default_rng(1).normal(size=500))])
@pytest.mark.parametrize("rows_per_range", [1, 7, 1000])
def test_exact_quantiles(spark, values, rows_per_range):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    out = {r.prob: r.value for r in aggregate.exact_quantiles(df, "v", probs, rows_per_range).collect()}
    assert out == pytest.approx({p: float(np.quantile(values, p)) for p in probs})


def test_reply_key(spark):
    df = spark.createDataFrame([(" Hi ", 1), ("hi", 1), ("hi", 2)], "t string, h int")
    keys = [r.k for r in df.select(U.reply_key(F.col("t"), F.struct("h")).alias("k")).collect()]
    assert keys[0] == keys[1] != keys[2]


def test_stream_equals_batch_over_several_files(spark, tmp_path):
    rows = spark.range(400).select(
        F.timestamp_seconds(F.lit(1_700_000_100) + F.col("id") * 97).alias("ts"), (F.col("id") % 3).cast("string").alias("event_type"), (F.col("id") % 5).alias("user_id"))
    for i in range(4):
        rows.filter(F.floor((F.unix_timestamp("ts") - 1_700_000_100) / 9700) == i).coalesce(1).write.parquet(
            str(tmp_path / "in"), mode="append")
    batch = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    dedupe = lambda d: U.reply_dedupe(d, F.col("event_type"), F.struct("user_id"))
    got = U.run_to_table(dedupe(stream), "t_dedupe")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dedupe(batch).collect()))
