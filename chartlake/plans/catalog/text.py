"""Turn labels, entities and routing."""

from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake import fixtures
from chartlake.functions.text import NAME_WORD, words
from chartlake.operators import entities as E
from chartlake.operators import turns as T
from chartlake.operators.windows import distinct_on_best
from chartlake.plans import gold as G
from chartlake.plans import questions as Qs
from chartlake.plans.catalog.base import ORACLES, over_silver, query, silver, stored
from chartlake.plans.catalog.gold import ARTISTS_RANKED

WORD = r"[\p{L}\p{N}]+"


def template_sql(template: str) -> str:
    return f"replace(replace(replace('{template}', '{{name}}', name), '{{typo}}', replace(name, 'y', '')), '{{year}}', CAST(year AS VARCHAR))"


def questions_sql(source: str, templates: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}|' || name || '|' || year AS question_id, {template_sql(text)} AS text FROM {source}"
        for kind, text in templates.items()
    )


QUESTIONS_CTE = f"""{ARTISTS_RANKED},
country_years AS (SELECT DISTINCT country_name AS name, year FROM silver),
artist_years AS (SELECT DISTINCT artist_name AS name, year FROM artist_performance),
questions AS MATERIALIZED ({questions_sql('country_years', Qs.COUNTRY_TEMPLATES)} UNION ALL {questions_sql('artist_years', Qs.ARTIST_TEMPLATES)}),
artist_names AS (SELECT artist_name, artist_uri FROM (SELECT artist_name, artist_uri, sum(total_streams) AS total FROM artist_performance
  WHERE length(artist_name) >= 5 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY total DESC, artist_uri) = 1),
names AS (SELECT artist_name AS entity, artist_uri AS key, 'artist' AS kind FROM artist_names
  UNION ALL SELECT DISTINCT country_name, country_name, 'country' FROM silver),
dictionary AS (SELECT entity, key, kind, array_to_string(regexp_extract_all(lower(entity), '{WORD}'), ' ') AS phrase FROM names),
sizes AS (SELECT DISTINCT len(string_split(phrase, ' ')) AS n FROM dictionary WHERE phrase <> ''),
tokens AS (SELECT question_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM questions),
places AS (SELECT question_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM tokens, sizes),
grams AS MATERIALIZED (SELECT DISTINCT question_id, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM places),
mentions AS MATERIALIZED (SELECT DISTINCT question_id, entity, key, kind FROM grams JOIN dictionary USING (phrase))"""


def artists(spark, sf):
    return G.artist_performance_ranked(silver(spark, sf))


def artist_names(artist_performance):
    """Each artist name of five letters or more, with the uri that has the most streams under it."""
    best = distinct_on_best(artist_performance, "artist_name", "artist_uri", "total_streams", K.MIN_ENTITY_LENGTH)
    return E.name_dictionary(best, "artist_name", "artist_uri")


def country_names(country_rows):
    return E.name_dictionary(country_rows.select("country_name").distinct(), "country_name")


def questions_of(country_rows, artist_performance):
    return Qs.country_questions(country_rows).unionByName(Qs.artist_questions(artist_performance))


def questions(spark, sf):
    return questions_of(silver(spark, sf), artists(spark, sf))


def all_names(spark, sf):
    _, countries, singers = asked(spark, sf)
    return singers.unionByName(countries)


#: The columns of the chart that questions and names are built from.
ASKED_COLUMNS = (*G.PLACE, "uri", "streams", "rank", "hit_category", "artist_uris", "artist_names")


def asked(spark, sf):
    """(questions, country names, artist names), written once per session and input folder.

    Chart and artists are read as wholes, so they are written as they come, not dealt out by month, and of the chart only some columns.
    """

    def write(out):
        silver(spark, sf).select(*ASKED_COLUMNS).write.parquet(f"{out}/silver")
        chart = spark.read.parquet(f"{out}/silver")
        G.artist_performance_ranked(chart).write.parquet(f"{out}/artist_performance_ranked")
        performance = spark.read.parquet(f"{out}/artist_performance_ranked")
        tables = {"questions": questions_of(chart, performance), "countries": country_names(chart), "artists": artist_names(performance)}
        for name, df in tables.items():
            df.write.parquet(f"{out}/{name}")
        return tuple(spark.read.parquet(f"{out}/{name}") for name in tables)

    return stored(spark, sf, "asked", write)


query("chart_questions", over_silver(f"{QUESTIONS_CTE} SELECT * FROM questions"))(questions)


# --- labels -------------------------------------------------------------------------------


def any_sql(x: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({x}, '" + p.replace("'", "''") + "')" for p in phrases) + ")"


def list_sql(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


LABEL_SQL = f"""asked AS (SELECT question_id, text FROM questions
  UNION ALL SELECT 'turn|' || conv_id || '|' || turn, text FROM conversations WHERE role = 'user'),
marked AS (SELECT *, lower(text) AS l, regexp_replace(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')), '\\s*[!.?]+$', '') AS f,
  regexp_extract_all(text, '\\b(20\\d{{2}})\\b', 1) AS y FROM asked),
flagged AS (SELECT *, string_split_regex(f, '\\s+') AS t, CAST(y[1] AS INT) AS y1, CAST(y[2] AS INT) AS y2,
  CASE {' '.join(f"WHEN {any_sql('l', ks)} THEN '{t}'" for t, ks in K.TABLE_KEYWORDS.items())} END AS tab FROM marked),
intents AS (SELECT *,
  (len(t) <= 4 AND (list_contains({list_sql(K.GREETING_WORDS)}, t[1]) OR {' OR '.join(f"starts_with(f, '{w}')" for w in K.THANKS_WORDS)}))
    OR {any_sql('f', K.META_PHRASES)} AS small_talk,
  {any_sql('l', K.FOLLOWUP_PHRASES)}
    OR list_has_any(regexp_extract_all(l, '[a-z'']+'), {list_sql((*K.FOLLOWUP_WORDS, *K.COMPARISON_WORDS))}) AS follow_up,
  CASE WHEN {any_sql('l', K.COUNT_KEYWORDS)} AND contains(l, 'stream') THEN 'sum' WHEN tab IS NULL THEN 'none'
    WHEN {any_sql('l', K.COUNT_KEYWORDS)} THEN CASE WHEN tab = 'kpi_song' AND contains(l, 'hit') THEN 'count_hits' ELSE 'count' END
    WHEN {any_sql('l', K.TREND_KEYWORDS)} THEN CASE WHEN y1 IS NOT NULL THEN 'trend' ELSE 'none' END
    WHEN {any_sql('l', K.SUPERLATIVE_KEYWORDS)} THEN 'superlative' ELSE 'none' END AS intent FROM flagged)
SELECT question_id, text, small_talk, follow_up, intent,
  CASE WHEN intent <> 'none' THEN coalesce(tab, 'country_performance') END AS target_table,
  CASE WHEN intent = 'trend' THEN greatest(y1, y2) WHEN intent IN ('sum', 'count_hits') THEN y1 END AS target_year,
  CASE WHEN intent = 'trend' THEN CASE WHEN y2 IS NULL THEN y1 - 1 ELSE least(y1, y2) END END AS previous_year,
  intent IN ('trend', 'superlative') AND {any_sql('l', K.ASCENDING_KEYWORDS)} AS ascending FROM intents"""


@query("label_turns", over_silver(f"{QUESTIONS_CTE}, {LABEL_SQL}"))
def label_turns(spark, sf):
    spoken = fixtures.table(spark, sf, "conversations").filter("role = 'user'").select(
        F.concat_ws("|", F.lit("turn"), "conv_id", "turn").alias("question_id"), "text"
    )
    return T.label_turns(questions(spark, sf).unionByName(spoken))


# --- entities -----------------------------------------------------------------------------

query(
    "detect_entities",
    over_silver(f"{QUESTIONS_CTE} SELECT question_id, entity, key, CAST(length(entity) AS INT) AS entity_length FROM mentions"),
)(lambda spark, sf: E.detect_entities(asked(spark, sf)[0], ["question_id"], "text", all_names(spark, sf), by_runs=None))
query("detect_entities_by_runs", ORACLES["detect_entities"])(
    lambda spark, sf: E.detect_entities(asked(spark, sf)[0], ["question_id"], "text", all_names(spark, sf), by_runs=True)
)

VOCABULARY_SQL = f"""vocabulary AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS entity FROM benchmark),
known AS (SELECT entity FROM vocabulary WHERE length(entity) >= 5)"""


def vocabulary(spark, sf):
    """The benchmark's long words, as an entity dictionary for free text."""
    tokens = fixtures.table(spark, sf, "benchmark").select(F.explode(words(F.col("text"), NAME_WORD)).alias("word"))
    return E.name_dictionary(tokens.filter(F.length("word") >= K.MIN_ENTITY_LENGTH).distinct(), "word")


query(
    "join_theta_text",
    f"""WITH {VOCABULARY_SQL}, tokens AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS entity FROM documents)
    SELECT doc_id, count(*) AS n_entities, min(entity) AS first_entity, max(CAST(length(entity) AS INT)) AS longest
    FROM tokens JOIN known USING (entity) GROUP BY doc_id""",
)(
    lambda spark, sf: E.detect_entities(fixtures.documents(spark, sf), ["doc_id"], "text", vocabulary(spark, sf))
    .groupBy("doc_id")
    .agg(
        F.count(F.lit(1)).alias("n_entities"), F.min("entity").alias("first_entity"), F.max("entity_length").alias("longest")
    )
)

query(
    "text_ngrams",
    """WITH w AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[a-z0-9'']+') AS t FROM conversations),
    g AS (SELECT conv_id, turn, unnest(t) AS gram FROM w
      UNION ALL SELECT conv_id, turn, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i+1])) FROM w
      UNION ALL SELECT conv_id, turn, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i+1] || ' ' || t[i+2])) FROM w)
    SELECT gram, count(*) AS turns FROM (SELECT DISTINCT * FROM g) GROUP BY gram""",
)(
    lambda spark, sf: E.text_ngrams(fixtures.table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text")
    .groupBy("gram")
    .agg(F.count(F.lit(1)).alias("turns"))
)

query("fuzzy_match")(
    lambda spark, sf: E.fuzzy_match(asked(spark, sf)[0], ["question_id"], "text", all_names(spark, sf))
)
KEYWORD = " ".join(f"WHEN {any_sql('lower(text)', ks)} THEN '{t}'" for t, ks in K.TABLE_KEYWORDS.items())
ROUTED_CTE = f"""named AS MATERIALIZED (SELECT question_id, max(CASE WHEN kind = 'country' THEN 1 ELSE 0 END) AS country,
    max(CASE WHEN kind = 'artist' THEN 1 ELSE 0 END) AS artist FROM mentions GROUP BY question_id),
  routed AS MATERIALIZED (SELECT question_id, CASE WHEN country = 1 THEN 'country_performance' WHEN artist = 1 THEN 'artist_performance' {KEYWORD} END AS source_table
    FROM questions LEFT JOIN named USING (question_id)),
  routed_flags AS (SELECT *, source_table IS NOT NULL AS confident FROM routed)"""
query("route_table", over_silver(f"{QUESTIONS_CTE}, {ROUTED_CTE} SELECT * FROM routed_flags"))(
    lambda spark, sf: E.route_table(asked(spark, sf)[0], ["question_id"], "text", *asked(spark, sf)[1:], fuzzy=False)
)
query("route_table_fuzzy")(
    lambda spark, sf: E.route_table(
        asked(spark, sf)[0], ["question_id"], "text", asked(spark, sf)[1].unionByName(E.alias_dictionary(spark)), asked(spark, sf)[2],
    )
)

# --- conversations ------------------------------------------------------------------------

SPOKEN = f"""spoken AS (SELECT DISTINCT conv_id, turn, entity FROM (SELECT conv_id, turn,
  unnest(regexp_extract_all(lower(text), '{WORD}')) AS entity FROM conversations) JOIN known USING (entity))"""


@query(
    "carry_forward_entities",
    f"""WITH {VOCABULARY_SQL}, {SPOKEN},
    latest AS (SELECT c.conv_id, c.turn, m.entity, max(m.turn) AS seen FROM conversations c JOIN spoken m
      ON c.conv_id = m.conv_id AND m.turn < c.turn GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY seen DESC, length(entity) DESC, entity) AS r FROM latest),
    said AS (SELECT c.conv_id, c.turn, u.text FROM conversations c JOIN conversations u
      ON c.conv_id = u.conv_id AND u.turn < c.turn AND u.role = 'user'
      QUALIFY row_number() OVER (PARTITION BY c.conv_id, c.turn ORDER BY u.turn DESC) = 1)
    SELECT conv_id, turn, a.entity AS entity_1, b.entity AS entity_2,
      CAST(nullif(regexp_extract(said.text, '\\b(20\\d{{2}})\\b', 1), '') AS INT) AS user_year
    FROM conversations LEFT JOIN (SELECT * FROM ranked WHERE r = 1) a USING (conv_id, turn)
    LEFT JOIN (SELECT * FROM ranked WHERE r = 2) b USING (conv_id, turn) LEFT JOIN said USING (conv_id, turn)""",
)
def carry_forward_entities(spark, sf):
    talk = fixtures.table(spark, sf, "conversations")
    mentions = E.detect_entities(talk, ["conv_id", "turn"], "text", vocabulary(spark, sf))
    return T.carry_forward_entities(talk, mentions, block=4)


query(
    "last_n_turns",
    """SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS history FROM (SELECT * FROM conversations
       QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 2) GROUP BY conv_id""",
)(lambda spark, sf: T.last_n_turns(fixtures.table(spark, sf, "conversations")))
