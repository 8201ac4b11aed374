"""The stored keyword index against keyword_search, and searches that only exclude against a plain scan."""

import random

import pytest
from pyspark.sql import functions as F

from chartlake.operators import keyword_index as X
from chartlake.operators import retrieval as R
from tests.test_retrieval import CHUNKS, SEARCHES

CORPUS = "source_table string, source_key string, chunk_text string, scope string"


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "source_key", "score", "rank").collect()))


@pytest.fixture(scope="module")
def words(spark, tmp_path_factory):
    rnd = random.Random(8)
    vocabulary = [f"w{k}x" for k in range(60)]
    def text():
        return " ".join(rnd.choice(vocabulary[: rnd.choice([3, 20, 60])]) for _ in range(rnd.choice([4, 8, 30, 90])))
    rows = [("t", f"k{k:04d}", text(), f"s{k % 3}") for k in range(1500)] + [("t", "null", None, "s0"), ("t", "zero", "", None)]
    rows += [("t", f"same{k:03d}", "w1x w2x equal texts", "s1") for k in range(300)]
    corpus = spark.createDataFrame(rows, CORPUS).repartition(6)
    return rows, corpus, X.build_keyword_index(corpus, str(tmp_path_factory.mktemp("kw") / "index"), block_docs=40)


def asked(spark, scoped):
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(60)}x" for _ in range(rnd.choice([1, 1, 2, 3]))) for _ in range(40)]
    texts += ["w1x w2x", "w0x -w1x", '"w1x w2x"', "w5x or w7x", '"w0x w1x" or w50x -"w2x w0x"', "nosuch", "w1x nosuch", "equal"]
    scope = lambda k: f"s{k % 4}" if scoped and k % 2 else None
    return spark.createDataFrame([(f"q{k}", t, scope(k)) for k, t in enumerate(texts)], "query_id string, text string, scope string")


@pytest.mark.parametrize("scoped", [False, True])
def test_same_as_plain_search(spark, words, scoped):
    _, corpus, index = words
    q = asked(spark, scoped)
    if not scoped:
        q = q.drop("scope")
    assert rows_of(X.search_keywords(index, q, 7)) == rows_of(R.keyword_search(corpus, q, 7))


def test_blocks_are_skipped(spark, words):
    _, _, index = words
    candidates, scored, _ = X.search_rounds(index, asked(spark, False).drop("scope"), 3)
    share = X.postings_share(candidates, scored).first()
    assert 0 < share["read"] < 0.6 * share["all"]


@pytest.mark.parametrize("text", [t for t in SEARCHES if t != "-label"])
def test_matches(spark, text, tmp_path):
    corpus = spark.createDataFrame([("t", k, v) for k, v in CHUNKS.items()], "source_table string, source_key string, chunk_text string")
    index = X.build_keyword_index(corpus, str(tmp_path / "index"))
    found = X.search_keywords(index, spark.createDataFrame([("q", text)], "query_id string, text string"), 10)
    assert {r.source_key for r in found.collect()} == SEARCHES[text]


def test_exclusions_alone_find_the_rest(spark, words):
    rows, _, index = words
    holds = {k: set((t or "").split()) for _, k, t, _ in rows}
    scope_of = {k: s for _, k, _, s in rows}
    searches = {
        "a": ("-w1x", None, lambda k, t: "w1x" not in holds[k]), "b": ("-w0x -w1x", "s1", lambda k, t: not holds[k] & {"w0x", "w1x"}),
        "c": ('-"w1x w2x"', None, lambda k, t: " w1x w2x " not in f" {t or ''} "), "d": ("-nosuch", None, lambda k, t: True),
        "e": ('-"no such" -w2x', "s9", lambda k, t: False), "f": ("-the", None, lambda k, t: False),
    }
    q = spark.createDataFrame([(n, s, c) for n, (s, c, _) in searches.items()], "query_id string, text string, scope string")
    got = {}
    for r in X.search_keywords(index, q, 12).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["source_key"], r["score"]))
    for name, (_, scope, keep) in searches.items():
        keys = sorted(k for _, k, t, _ in rows if keep(k, t) and (scope is None or scope_of[k] == scope))[:12]
        assert sorted(got.get(name, [])) == [(n, k, 0.0) for n, k in enumerate(keys)]


def test_exclusion_beside_another_alternative(spark, words):
    _, _, index = words
    q = spark.createDataFrame([("q", "w59x or -w0x")], "query_id string, text string")
    found = X.search_keywords(index, q, 5).orderBy("rank").collect()
    assert [r["rank"] for r in found] == [0, 1, 2, 3, 4] and found[0]["score"] > 0


def test_empty_corpus(spark, tmp_path):
    index = X.build_keyword_index(spark.createDataFrame([], CORPUS), str(tmp_path / "none"))
    q = spark.createDataFrame([("q", "a b"), ("r", "-a")], "query_id string, text string")
    assert X.search_keywords(index, q, 3).count() == 0


def test_exclusions_look_at_few_places(spark, words, monkeypatch):
    """Equal exclusions once, and only the places up to the k-th free one; whatever is excluded, from none to all."""
    rows, _, index = words
    monkeypatch.setattr(X, "PLACES", 8)
    words_of = {k: set((t or "").split()) for _, k, t, _ in rows}
    texts = ["-w0x", "-w1x", "-w2x", "-w3x", "-w40x", "-w59x", "-w0x -w1x -w2x", "-nosuch", "-equal", '-"w0x w1x" -w5x']
    q = spark.createDataFrame([(f"{n}/{i}", t) for n, t in enumerate(texts) for i in range(30)], "query_id string, text string")
    got = {}
    for r in X.search_keywords(index, q, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["source_key"]))
    for n, t in enumerate(texts):
        bad = {w.strip('-"') for w in t.split() if '"' not in w}
        free = [k for k, own in sorted(words_of.items()) if not own & bad]
        if '"' in t:
            text_of = {k: f" {x or ''} " for _, k, x, _ in rows}
            free = [k for k, own in sorted(words_of.items()) if "w5x" not in own and " w0x w1x " not in text_of[k]]
        for i in range(30):
            assert sorted(got.get(f"{n}/{i}", [])) == list(enumerate(free[:20]))
    asked = spark.createDataFrame([("a", 0, p) for p in (*range(3, 40), 41, 100, *range(200, 900))] + [("b", 0, 500)] + [("c", 0, p) for p in range(96)], "query_id string, alternative int, place long")
    last = {r[0]: r[1] for r in X._first_places(asked, 5).collect()}
    assert last == {"a": 48, "b": 8, "c": 104}


def test_words_are_counted_without_a_shuffle(spark):
    rows = [(0, 7, 3, ["a", "b", "a"], " a the b a "), (1, 8, 0, [], None), (0, 9, 1, ["c"], " c ")]
    docs = spark.createDataFrame(rows, "block long, place long, length int, terms array<string>, text string")
    counts = X.term_counts(docs)
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == [("a", 0, 7, 3, 2.0), ("b", 0, 7, 3, 1.0), ("c", 0, 9, 1, 1.0), ("the", 0, 7, 3, 0.0)]

