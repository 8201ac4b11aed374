"""Turn labels, entities, fuzzy names and carried context against plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from chartlake.functions.text import stem
from chartlake.operators import entities as E
from chartlake.operators import turns as T


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b))


def test_similar_names_miss_nothing(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 34))).strip() or "a" for _ in range(120)]
    grams = set()
    for name in names:
        for _ in range(6):
            chars = list(name)
            for _ in range(rng.randint(0, 1 + len(name) // 5)):
                spot = rng.randrange(len(chars) + 1)
                if rng.random() < 0.5 and len(chars) > 1:
                    chars.pop(min(spot, len(chars) - 1))
                else:
                    chars.insert(spot, rng.choice("abcd"))
            grams.add("".join(chars))
    found = E.similar_names(
        spark.createDataFrame([(g,) for g in grams], "gram string"),
        spark.createDataFrame([(n, n) for n in set(names)], "entity string, key string"),
    )
    got = {(r.gram, r.entity): round(r.score, 6) for r in found.collect()}
    want = {(g, n): round(ratio(g, n), 6) for g, n in itertools.product(grams, set(names)) if ratio(g, n) >= 90}
    assert got == want and len(want) > 100


QUESTIONS = [
    ("How did Kendrick Lamar perform in 2024?", "none", None, None),
    ("Which country had the strongest streaming numbers?", "superlative", "country_performance", None),
    ("Which artist grew the most in 2023?", "trend", "artist_performance", 2023),
    ("Which country grew fastest between 2023 and 2021?", "trend", "country_performance", 2023),
    ("Which artist grew the most?", "none", None, None),
    ("How many labels are there in total?", "count", "label_performance_enhanced", None),
    ("How many total streams does Brazil have in 2022?", "sum", "country_performance", 2022),
    ("how many hit songs were there in 2020", "count_hits", "kpi_song", 2020),
    ("What is the weather like today?", "none", None, None),
    ("which artist has the most tracks", "superlative", "artist_performance", None),
]


@pytest.mark.parametrize("text, intent, table, year", QUESTIONS)
def test_intents(spark, text, intent, table, year):
    out = T.label_turns(spark.createDataFrame([(text,)], "text string")).first()
    assert (out.intent, out.target_table, out.target_year) == (intent, table, year)


@pytest.mark.parametrize(
    "text, small, follow",
    [("  Hi there! ", True, False), ("thanks for the india stats", False, False), ("Thanks a lot", True, False), ("hello", True, False), ("hello there my friend !", True, False),
     ("so what can you do for me", True, False), ("what about Brazil?", False, True), ("Is it larger", False, True),
     ("who has more streams", False, True), ("Tell me about India", False, False)],
)
def test_small_talk_and_follow_up(spark, text, small, follow):
    out = T.label_turns(spark.createDataFrame([(text,)], "text string")).first()
    assert (out.small_talk, out.follow_up) == (small, follow)


@pytest.fixture
def names(spark):
    countries = E.name_dictionary(spark.createDataFrame([("India",), ("United States",), ("Brazil",)], "n string"), "n")
    artists = E.name_dictionary(spark.createDataFrame([("Tream", "a:1"), ("Taylor Swift", "a:2"), ("TOODAY", "a:3")], "n string, k string"), "n", "k")
    return countries.unionByName(E.alias_dictionary(spark)), artists


def test_names_match_whole_words(spark, names):
    countries, artists = names
    q = spark.createDataFrame([(1, "the streams of taylor swift, in the US and india"), (2, "bonus streams")], "id int, text string")
    assert {(r.id, r.key) for r in E.detect_entities(q, ["id"], "text", artists).collect()} == {(1, "a:2")}
    ordered = E.ordered_mentions(E.detect_entities(q, ["id"], "text", countries), ["id"]).collect()
    assert [(r.id, r.entities) for r in ordered] == [(1, ["United States", "India"])]


def test_routes(spark, names):
    rows = [(1, "how is india doing"), (2, "did taylor swift do well"), (3, "which artist"), (4, "Taylr Swift in 2020"), (5, "what now today"), (6, "xyz"),
            (7, "indai or brazill")]
    out = E.route_table(spark.createDataFrame(rows, "id int, text string"), ["id"], "text", *names).collect()
    assert {r.id: (r.source_table, r.confident) for r in out} == {
        1: ("country_performance", True), 2: ("artist_performance", True), 3: ("artist_performance", True), 4: ("artist_performance", False),
        5: ("artist_performance", False), 6: (None, False), 7: ("country_performance", False),
    }


def test_fuzzy_match_takes_the_best(spark, names):
    q = spark.createDataFrame([(1, "Taylr Swift"), (2, "nothing here")], "id int, text string")
    out = E.fuzzy_match(q, ["id"], "text", names[1]).collect()
    assert [(r.id, r.entity, round(r.score, 3)) for r in out] == [(1, "Taylor Swift", round(ratio("taylr swift", "taylor swift"), 3))]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_carried_context_equals_a_scan(spark, block):
    rng = random.Random(block)
    turns, mentions, want = [], [], {}
    for conv in range(4):
        recent, year = [], None
        for turn in range(rng.randint(5, 25)):
            want[conv, turn] = (*(recent + [None, None])[:2], year)
            said = rng.sample(["aa", "bbb", "cccc", "ddddd"], rng.choice([0, 0, 1, 2, 3]))
            said.sort(key=lambda e: (-len(e), e))
            mentions += [(conv, turn, e, len(e)) for e in said]
            recent = list(dict.fromkeys(said + recent))
            role = rng.choice(["user", "assistant"])
            mention_year = rng.choice([None, 2020, 2021])
            if role == "user":
                year = mention_year
            turns.append((conv, turn, role, f"text {mention_year or ''}"))
    out = T.carry_forward_entities(
        spark.createDataFrame(turns, "conv_id int, turn int, role string, text string"),
        spark.createDataFrame(mentions, "conv_id int, turn int, entity string, entity_length int"), block=block,
    )
    assert {(r.conv_id, r.turn): (r.entity_1, r.entity_2, r.user_year) for r in out.collect()} == want


def test_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([(1, "A b a b"), (2, "x"), (3, "")], "id int, text string")
    out = {}
    for r in E.text_ngrams(df, "text").collect():
        out.setdefault(r.id, set()).add(r.gram)
    assert out == {1: {"a", "b", "a b", "b a", "a b a", "b a b"}, 2: {"x"}}


@pytest.mark.parametrize("word, root", [("countries", "country"), ("streams", "stream"), ("hits", "hit"), ("bus", "bus"), ("pass", "pass"), ("places", "place")])
def test_stem(spark, word, root):
    assert spark.range(1).select(stem(F.lit(word)).alias("s")).first().s == root


@pytest.mark.parametrize("text", ["How is India's growth", "the 'india' market", "pan-india charts", "India?", "\u201cIndia\u201d"])
def test_names_at_word_boundaries(spark, text):
    names = E.name_dictionary(spark.createDataFrame([("India",), ("Indiana",)], "n string"), "n")
    found = E.detect_entities(spark.createDataFrame([(1, text)], "id int, text string"), ["id"], "text", names)
    assert [r.entity for r in found.collect()] == ["India"]


def test_kinds_come_before_lengths(spark):
    turns = spark.createDataFrame([(1, 1, "user", "x"), (1, 2, "user", "y")], "conv_id int, turn int, role string, text string")
    rows = [(1, 1, "a very long artist", 18, 1), (1, 1, "brazil", 6, 0), (1, 1, "some artist", 11, 1)]
    mentions = spark.createDataFrame(rows, "conv_id int, turn int, entity string, entity_length int, kind_rank int")
    out = {r.turn: (r.entity_1, r.entity_2) for r in T.carry_forward_entities(turns, mentions).collect()}
    assert out == {1: (None, None), 2: ("brazil", "a very long artist")}


@pytest.mark.parametrize("by_runs", [False, True])
def test_names_by_automaton_and_by_runs(spark, by_runs):
    names = spark.createDataFrame(
        [("Ana", "a1"), ("Ana Lu", "a2"), ("Lu", "a3"), ("Lu", "a4"), ("Ána-Lu", "a5"), ("São Paulo", "c1"), ("...", "none")], "name string, key string")
    dictionary = E.name_dictionary(names, "name", "key")
    texts = spark.createDataFrame(
        [(1, "ana lu, LU!"), (2, "Anaconda lux"), (3, None), (4, ""), (5, "são  paulo's Ána lu"), (6, "lu ana ana lu lu")], "id long, text string")
    got = sorted(tuple(r) for r in E.detect_entities(texts, ["id"], "text", dictionary, by_runs).select("id", "entity", "key").collect())
    expected = [(1, "Ana", "a1"), (1, "Ana Lu", "a2"), (1, "Lu", "a3"), (1, "Lu", "a4"), (5, "Lu", "a3"), (5, "Lu", "a4"), (5, "São Paulo", "c1"), (5, "Ána-Lu", "a5"),
                (6, "Ana", "a1"), (6, "Ana Lu", "a2"), (6, "Lu", "a3"), (6, "Lu", "a4")]
    assert got == sorted(expected)
    assert E.detect_entities(texts, ["id"], "text", dictionary.filter("false"), by_runs).count() == 0


def test_long_name_lists_are_refused(spark, monkeypatch):
    monkeypatch.setattr(E, "DICTIONARY_CHARS", 10)
    dictionary = E.name_dictionary(spark.createDataFrame([("Ana",)], "name string"), "name")
    with pytest.raises(ValueError, match="by_runs"):
        E.detect_entities(spark.createDataFrame([(1, "ana")], "id long, text string"), ["id"], "text", dictionary)
