"""Chunks, nearest neighbours, keyword search and the retrieval jobs.

A retrieval job writes the monthly tables and the chunk table once and reads them in all its steps.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake import fixtures
from chartlake.functions.vectors import embed, hashed_counts
from chartlake.operators import answers as A
from chartlake.operators import chunk_store as CS
from chartlake.operators import entities as E
from chartlake.operators import keyword_index as X
from chartlake.operators import retrieval as R
from chartlake.operators import turns as T
from chartlake.operators import vector_index as V
from chartlake.operators.windows import top_k_per_group
from chartlake.plans import chunks as C
from chartlake.plans import gold as G
from chartlake.plans.catalog import text as TX
from chartlake.plans.catalog.base import IS_HIT, ORACLES, STREAMS, over_silver, query, r2, silver, stored
from chartlake.plans.catalog.gold import ARTISTS_RANKED, CATALOG, COUNTRY_PERFORMANCE, KEY
from chartlake.plans.catalog.relational import COUNTRY_YEAR
from chartlake.session import work_dir

VECTOR = ("vec_id",)

# --- chunks -------------------------------------------------------------------------------


def chunks(spark, sf):
    """From monthly tables that are written once, so the cleaned chart is built once, not for each of them."""
    return served(spark, sf, vectors=False).chunks.select("source_table", "source_key", "chunk_text")


def commas(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def two(x: str) -> str:
    return f"coalesce(printf('%.2f', {r2(x)}), 'nan')"


CHUNKS_CTE = f"""{COUNTRY_PERFORMANCE}{COUNTRY_YEAR}{ARTISTS_RANKED}{CATALOG},
kpi AS (SELECT {KEY}, uri, standardized_label, {STREAMS} AS total_streams, max(CASE WHEN {IS_HIT} THEN 1 ELSE 0 END) AS is_hit FROM silver GROUP BY ALL),
labels_month AS (SELECT {KEY}, standardized_label, {STREAMS} AS total_streams, count(DISTINCT uri) AS active_songs,
  count(DISTINCT artist_names) AS active_artists FROM silver GROUP BY ALL),
label_year AS (SELECT standardized_label, year, sum(total_streams) AS s, max(active_songs) AS n, max(active_artists) AS a FROM labels_month GROUP BY ALL),
song_year AS (SELECT uri, year, min(standardized_label) AS l, sum(total_streams) AS s, max(is_hit) AS h FROM kpi GROUP BY ALL),
artist_year AS (SELECT artist_uri, year, min(artist_name) AS name, sum(total_streams) AS s, sum(track_count) AS t, sum(hit_track_count) AS h,
  min(best_rank) AS r FROM artist_performance GROUP BY ALL),
chunks AS (
  SELECT 'country_performance' AS source_table, country_name || '|' || year AS source_key,
    'In ' || country_name || ' during ' || year || ', Spotify recorded ' || {commas('total_streams')} || ' total streams, with up to '
    || active_songs || ' active song(s) (up to ' || hit_songs || ' of them hits) and an average chart strength of ' || {two('avg_chart_strength')}
    || '. Up to ' || coalesce(active_artists, 0) || ' active artists were represented that year, with average growth of '
    || {two('growth_percentage')} || '%. Most recent top song was ' || coalesce(top_song_name, 'None') || ', top artist was '
    || coalesce(top_artist_name, 'None') || '.' AS chunk_text FROM country_year
  UNION ALL SELECT 'label_performance_enhanced', standardized_label || '|' || year, 'Label ' || standardized_label || ' in ' || year || ' had '
    || {commas('s')} || ' total streams across up to ' || n || ' active song(s) from up to ' || a || ' artist(s).' FROM label_year
  UNION ALL SELECT 'kpi_song', uri || '|' || year, 'Track "' || coalesce(track_name, uri) || '"'
    || CASE WHEN l <> '' THEN ' on label ' || l ELSE '' END || ' had ' || {commas('s')} || ' total streams in ' || year || ' and '
    || CASE WHEN h = 1 THEN 'was a hit' ELSE 'was not a hit' END || ' that year.' FROM song_year LEFT JOIN track_catalog USING (uri)
  UNION ALL SELECT 'artist_performance', artist_uri || '|' || year, 'In ' || year || ', artist ' || name || ' (' || artist_uri || ') had '
    || {commas('s')} || ' total streams across up to ' || t || ' charting track appearance(s), including ' || h
    || ' hit track appearance(s), reaching a best chart rank of ' || r || ' that year.' FROM artist_year)"""
query("render_chunks", over_silver(f"{CHUNKS_CTE} SELECT * FROM chunks"))(chunks)


@dataclass
class Served:
    """What a retrieval job reads: chunks and questions, with or without vectors, and the name lists."""

    chunks: DataFrame
    questions: DataFrame
    countries: DataFrame
    artists: DataFrame
    country_years: DataFrame
    gold: dict[str, DataFrame]


TABLES = ("country_performance", "label_performance_enhanced", "kpi_song", "track_catalog", "artist_performance_ranked")


def served(spark, sf, vectors=True):
    """The monthly tables, chunks and questions, written once per session and input folder for all retrieval jobs."""
    return stored(spark, sf, f"served_{vectors}", lambda out: _serve(spark, sf, vectors, out))


#: The columns of the chart that TABLES are built from.
CHART_COLUMNS = G.CHART_COLUMNS
#: Chart rows a bucket should hold, and the least number of buckets.
BUCKET_ROWS, BUCKETS = 400_000, 32


def _monthly_tables(spark, sf, out):
    """TABLES, written from a chart that is bucketed by month and country: they all group by these and more, so its rows are shuffled once.

    A month's country is in one bucket. The tables are read as wholes, so they are written as they come, without partitions.
    """
    rows = fixtures.table(spark, sf, "lineitem").count()
    buckets, place = max(BUCKETS, -(-rows // BUCKET_ROWS)), list(G.PLACE)
    name = f"served_chart_{uuid.uuid4().hex}"
    dealt = silver(spark, sf).select(*CHART_COLUMNS).repartition(buckets, *place)
    dealt.write.bucketBy(buckets, *place).option("path", f"{out}/chart").saveAsTable(name)
    for table, df in _of_dealt_chart(spark.table(name)).items():
        df.write.parquet(f"{out}/{table}")
    return {table: spark.read.parquet(f"{out}/{table}") for table in TABLES}


def _of_dealt_chart(chart):
    options = {"artist_performance_ranked": {"dealt": True}}
    return {table: G.GOLD_TABLES[table][0](chart, **options.get(table, {})) for table in TABLES}


def _serve(spark, sf, vectors, out):
    tables = _monthly_tables(spark, sf, out)
    countries, singers = tables["country_performance"], tables["artist_performance_ranked"]
    texts = {
        "chunks": (C.render_chunks(*(tables[t] for t in TABLES)), "chunk_text"),
        "questions": (TX.questions_of(countries, singers).withColumnRenamed("question_id", "query_id"), "text"),
    }
    for name, (df, text) in texts.items():
        if name == "chunks":
            df = R.with_index(df)
        if vectors:
            df = df.withColumn("embedding", embed(F.col(text)))
        df.write.parquet(f"{out}/{name}")
    read = {name: spark.read.parquet(f"{out}/{name}") for name in texts}
    return Served(
        read["chunks"], read["questions"], TX.country_names(countries), TX.artist_names(singers),
        countries.select("country_name", F.col("year").cast("string").alias("year")).distinct(), tables,
    )


@query(
    "embed_text",
    """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9'']+')) AS word FROM documents),
    s AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(word), 1, 7) AS BIGINT) % 64 AS INT) AS position, count(*) AS n FROM w GROUP BY ALL)
    SELECT doc_id, position, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 4) AS weight FROM s""",
)
def embed_text(spark, sf):
    vectors = fixtures.documents(spark, sf).select("doc_id", embed(F.col("text"), hashed_counts(64)).alias("v"))
    return vectors.select("doc_id", F.posexplode("v").alias("position", "w")).filter("w > 0").select(
        "doc_id", "position", F.round(F.col("w").cast("double"), 4).alias("weight")
    )


# --- nearest neighbours over the vector table ---------------------------------------------
#
# The queries are the mean vectors of the labels: every row of the table takes part on both sides.

CENTRES_CTE = """dims AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) t(i) GROUP BY ALL),
centres AS (SELECT label, list(x ORDER BY i) AS q FROM dims GROUP BY label)"""


def vectors(spark, sf):
    return fixtures.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.col("label").cast("string").alias("source_label")
    )


def centres(spark, sf):
    each = fixtures.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = each.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda s: s["x"]).alias("embedding")).select(
        F.col("label").cast("string").alias("query_id"), "embedding"
    )


NEAR_SQL = """, d AS (SELECT CAST(label AS VARCHAR) AS query_id, vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), q), 6) AS distance
  FROM (SELECT vec_id, embedding, label AS own FROM embeddings) e, centres {where})
  SELECT query_id, vec_id, distance, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) - 1 AS INT) AS rank
  FROM d QUALIFY rank < 20"""
query("knn_exact", f"WITH {CENTRES_CTE}{NEAR_SQL.format(where='')}")(
    lambda spark, sf: R.knn_exact(vectors(spark, sf), centres(spark, sf), R.candidate_budget(), VECTOR)
)
query("knn_exact_scoped", f"WITH {CENTRES_CTE}{NEAR_SQL.format(where='WHERE own = label')}")(
    lambda spark, sf: R.knn_exact(
        vectors(spark, sf).withColumn("scope", F.col("source_label")),
        centres(spark, sf).withColumn("scope", F.col("query_id")), R.candidate_budget(), VECTOR,
    )
)
#: Lists of the stored index: about the square root of the row count.
LISTS_CTE = "lists AS (SELECT greatest(2, CAST(round(sqrt(count(*))) AS INT)) AS lists FROM embeddings)"


def index_of(spark, sf) -> V.VectorIndex:
    """The vector table as a stored index, with its labels as scopes."""
    rows = vectors(spark, sf).withColumn("scope", F.col("source_label"))
    return stored(spark, sf, "vector_index", lambda path: V.build_index(rows, path, _lists(rows), VECTOR))


def _lists(rows):
    return max(2, round(rows.count() ** 0.5))


query(
    "knn_exact_self",
    """WITH d AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_distance(CAST(b.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])), 6) AS distance
    FROM embeddings a, embeddings b) SELECT query_id, vec_id, distance,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) - 1 AS INT) AS rank FROM d QUALIFY rank < 5""",
)(
    lambda spark, sf: V.search_pivots(
        index_of(spark, sf), vectors(spark, sf).select(F.col("vec_id").alias("query_id"), "embedding"), 5
    )
)


@query("knn_ivf")
def knn_ivf(spark, sf):
    index = index_of(spark, sf)
    return V.search_lists(index, centres(spark, sf), K.TOP_K, max(1, _lists(vectors(spark, sf)) // 4))


query("knn_ivf_all_lists", f"WITH {CENTRES_CTE}{NEAR_SQL.format(where='')}")(
    lambda spark, sf: V.search_lists(index_of(spark, sf), centres(spark, sf), R.candidate_budget(), _lists(vectors(spark, sf)))
)
query("knn_ivf_scoped_all_lists", f"WITH {CENTRES_CTE}{NEAR_SQL.format(where='WHERE own = label')}")(
    lambda spark, sf: V.search_lists(
        index_of(spark, sf), centres(spark, sf).withColumn("scope", F.col("query_id")), R.candidate_budget(), _lists(vectors(spark, sf))
    )
)
query("knn_pivots_scoped", f"WITH {CENTRES_CTE}{NEAR_SQL.format(where='WHERE own = label')}")(
    lambda spark, sf: V.search_pivots(index_of(spark, sf), centres(spark, sf).withColumn("scope", F.col("query_id")), R.candidate_budget())
)

ENOUGH = 0.9


@query(
    "knn_recall_sweep",
    f"""WITH {LISTS_CTE} SELECT probes, lists, true AS enough, true AS complete FROM (
      SELECT 1 AS probes, lists FROM lists UNION SELECT greatest(1, CAST(floor(lists / CAST(2 AS DOUBLE)) AS INT)), lists FROM lists
      UNION SELECT lists, lists FROM lists)""",
)
def knn_recall_sweep(spark, sf):
    """Recall over all vectors as queries: at half of the lists at least ENOUGH, at all lists complete."""
    lists = _lists(vectors(spark, sf))
    asked = vectors(spark, sf).select(F.col("vec_id").alias("query_id"), "embedding")
    sweep = V.recall_sweep(index_of(spark, sf), asked, K.TOP_K, sorted({1, max(1, lists // 2), lists}))
    return sweep.select(
        "probes", F.lit(lists).alias("lists"), ((F.col("probes") < lists // 2) | (F.col("recall") >= ENOUGH)).alias("enough"),
        ((F.col("probes") < lists) | (F.col("worst") == 1.0)).alias("complete"),
    )


@query(
    "top1_distance",
    f"""WITH {CENTRES_CTE}, d AS (SELECT CAST(label AS VARCHAR) AS query_id, vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), q), 6) AS distance
    FROM (SELECT vec_id, embedding FROM embeddings) e, centres)
    SELECT query_id, vec_id, distance FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) = 1""",
)
def top1_distance(spark, sf):
    corpus, asked = vectors(spark, sf), centres(spark, sf)
    return R.top1_distance(R.knn_exact(corpus, asked, 1, VECTOR), asked, corpus, VECTOR)


# --- keyword search -----------------------------------------------------------------------

STOPS = "[" + ", ".join(f"'{w}'" for w in K.STOP_WORDS) + "]"
TOKEN = r"[\p{L}\p{N}]+"


def stem_sql(w: str) -> str:
    return (
        f"CASE WHEN regexp_matches({w}, '[^ea]ies$') THEN regexp_replace({w}, 'ies$', 'y') "
        f"WHEN regexp_matches({w}, '[^aeo]es$') THEN regexp_replace({w}, 'es$', 'e') "
        f"WHEN regexp_matches({w}, '[^us]s$') THEN regexp_replace({w}, 's$', '') ELSE {w} END"
    )


def terms_sql(x: str) -> str:
    return (
        f"list_transform(list_filter(regexp_extract_all(lower({x}), '{TOKEN}'), lambda w: NOT list_contains({STOPS}, w)), "
        f"lambda w: {stem_sql('w')})"
    )


def phrase_sql(x: str) -> str:
    return f"' ' || array_to_string(list_transform(regexp_extract_all(lower({x}), '{TOKEN}'), lambda w: {stem_sql('w')}), ' ') || ' '"


def bm25_sql(keys: str, docs: str, asked: str, k: int, where: str = "") -> str:
    """docs: keys, terms, body; asked: query_id, terms."""
    return f"""docs AS ({docs}), asked AS ({asked}),
  q AS (SELECT query_id, unnest(list_distinct(terms)) AS term, len(list_distinct(terms)) AS size FROM asked),
  tf AS (SELECT {keys}, term, count(*) AS tf FROM (SELECT {keys}, unnest(terms) AS term FROM docs) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  stats AS (SELECT count(*) AS n, avg(len(terms)) AS mean FROM docs),
  hit AS (SELECT query_id, {keys}, count(*) AS matched, any_value(size) AS size,
    sum(ln(1 + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.2 AS DOUBLE)
      / (tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len(terms) / mean))) AS score
    FROM q JOIN tf USING (term) JOIN df USING (term) JOIN docs USING ({keys}), stats GROUP BY ALL),
  full_hit AS (SELECT query_id, {keys}, round(score, 6) AS score FROM hit JOIN docs USING ({keys}) JOIN asked USING (query_id)
    WHERE matched = size {where})
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {keys}) - 1 AS INT) AS rank FROM full_hit QUALIFY rank < {k}"""




@query(
    "keyword_search",
    over_silver(
        f"""{CHUNKS_CTE}, country_years AS (SELECT DISTINCT country_name AS name, year FROM silver), """
        + bm25_sql(
            "source_table, source_key",
            f"SELECT source_table, source_key, {terms_sql('chunk_text')} AS terms, {phrase_sql('chunk_text')} AS body FROM chunks",
            f"SELECT name || '|' || year AS query_id, {terms_sql(chr(39).join(['name || ', ' ', ' || year || ', ' growth total streams', '']))} AS terms FROM country_years",
            15,
            "AND NOT list_contains(docs.terms, 'label') AND contains(body, ' total stream ')",
        )
    ),
)
def keyword_search(spark, sf):
    tables = served(spark, sf, vectors=False)
    asked = tables.country_years.select(
        F.concat_ws("|", "country_name", "year").alias("query_id"),
        F.concat("country_name", F.lit(" "), "year", F.lit(' growth -label "total streams" -"no such phrase"')).alias("text"),
    )
    return R.keyword_search(tables.chunks, asked, 15)


query(
    "keyword_search_documents",
    "WITH "
    + bm25_sql(
        "doc_id",
        f"SELECT doc_id, {terms_sql('text')} AS terms FROM documents",
        f"SELECT CAST(item_id AS VARCHAR) AS query_id, {terms_sql('text')} AS terms FROM benchmark",
        15,
    ),
)(
    lambda spark, sf: R.keyword_search(
        _indexed_documents(spark, sf),
        fixtures.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text"),
        15, keys=["doc_id"],
    )
)


def _indexed_documents(spark, sf):
    path = work_dir(spark, "document_index")
    R.with_index(fixtures.documents(spark, sf).select("doc_id", "text"), "text").drop("text").write.parquet(path)
    return spark.read.parquet(path)


# --- the stored keyword index ---------------------------------------------------------------


def chunk_index(spark, sf):
    chunks = served(spark, sf, vectors=False).chunks
    return stored(spark, sf, "chunk_keywords", lambda path: X.build_keyword_index(chunks, path))


def document_index(spark, sf):
    docs = fixtures.documents(spark, sf).select("doc_id", "text")
    return stored(spark, sf, "document_keywords", lambda path: X.build_keyword_index(docs, path, ["doc_id"], "text"))


@query("keyword_index_chunks", ORACLES["keyword_search"])
def keyword_index_chunks(spark, sf):
    asked = served(spark, sf, vectors=False).country_years.select(
        F.concat_ws("|", "country_name", "year").alias("query_id"),
        F.concat("country_name", F.lit(" "), "year", F.lit(' growth -label "total streams" -"no such phrase"')).alias("text"),
    )
    return X.search_keywords(chunk_index(spark, sf), asked, 15)


query("keyword_index_documents", ORACLES["keyword_search_documents"])(
    lambda spark, sf: X.search_keywords(
        document_index(spark, sf), fixtures.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text"), 15
    )
)


@query(
    "keyword_exclusions",
    f"""WITH docs AS (SELECT doc_id, {terms_sql('text')} AS terms FROM documents),
    asked AS (SELECT CAST(item_id AS VARCHAR) AS query_id, {terms_sql("regexp_extract(lower(text), '" + TOKEN + "')")} AS terms FROM benchmark)
    SELECT query_id, doc_id, CAST(0 AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY doc_id) - 1 AS INT) AS rank
    FROM asked, docs WHERE len(asked.terms) = 1 AND NOT list_contains(docs.terms, asked.terms[1]) QUALIFY rank < 15""",
)
def keyword_exclusions(spark, sf):
    """Searches of an exclusion alone: the first word of each benchmark text, excluded."""
    word = F.regexp_extract(F.lower("text"), "[\\p{L}\\p{N}]+", 0)
    asked = fixtures.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.concat(F.lit("-"), word).alias("text"))
    return X.search_keywords(document_index(spark, sf), asked, 15)


# --- fusion and reranking -----------------------------------------------------------------


@query(
    "rrf_merge",
    over_silver(
        f""", t AS (SELECT country_name AS query_id, uri, sum(streams) AS s, min(rank) AS r FROM silver GROUP BY ALL),
        a AS (SELECT query_id, uri, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, uri) - 1 AS ra FROM t QUALIFY ra < 20),
        b AS (SELECT query_id, uri, row_number() OVER (PARTITION BY query_id ORDER BY r, uri) - 1 AS rb FROM t QUALIFY rb < 20)
        SELECT query_id, uri, round(coalesce(1 / CAST(60 + ra AS DOUBLE), 0) + coalesce(1 / CAST(60 + rb AS DOUBLE), 0), 9) AS rrf_score
        FROM a FULL JOIN b USING (query_id, uri)"""
    ),
)
def rrf_merge(spark, sf):
    totals = silver(spark, sf).groupBy(F.col("country_name").alias("query_id"), "uri").agg(
        F.sum("streams").alias("s"), F.min("rank").alias("r")
    )
    best = [
        top_k_per_group(totals, ["query_id"], order, 20, "rank").withColumn("rank", F.col("rank") - 1)
        for order in ([F.desc("s"), "uri"], ["r", "uri"])
    ]
    return R.rrf_merge(*best, ["uri"]).withColumn("rrf_score", F.round("rrf_score", 9))


QUESTION_TERMS = r"list_distinct(regexp_extract_all(lower(q.text), '[a-z0-9'']+'))"


@query(
    "rerank_pairs",
    over_silver(
        f"""{CHUNKS_CTE}, own AS (SELECT source_table, source_key, chunk_text, regexp_replace(source_key, '[|][^|]*$', '') AS entity,
          regexp_extract(source_key, '[^|]*$') AS year FROM chunks),
        q AS (SELECT source_table, entity, concat_ws('|', 'lookup', source_table, entity, year) AS query_id, 'How did ' || entity || ' perform in ' || year || '?' AS text FROM own),
        p AS (SELECT query_id, source_table, source_key, len(list_intersect({QUESTION_TERMS},
          list_distinct(regexp_extract_all(lower(chunk_text), '[a-z0-9'']+')))) / CAST(len({QUESTION_TERMS}) AS DOUBLE) AS score
          FROM q JOIN own USING (source_table, entity))
        SELECT query_id, source_table, source_key, round(score, 9) AS score,
          CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source_key) - 1 AS INT) AS rank FROM p QUALIFY rank < 5"""
    ),
)
def rerank_pairs(spark, sf):
    """A question for every entity and year of all four tables, against the entity's own chunks."""
    chunks = served(spark, sf, vectors=False).chunks
    entity = F.regexp_replace("source_key", "\\|[^|]*$", "")
    own = chunks.select("source_table", "source_key", "chunk_text", entity.alias("entity"), F.substring_index("source_key", "|", -1).alias("year"))
    asked = own.select(
        "source_table", "entity", F.concat_ws("|", F.lit("lookup"), "source_table", "entity", "year").alias("query_id"),
        F.concat(F.lit("How did "), "entity", F.lit(" perform in "), "year", F.lit("?")).alias("text"),
    )
    return R.rerank_pairs(None, asked, own, within=["source_table", "entity"]).withColumn("score", F.round("score", 9))


def _mentions(t, questions=None):
    asked = t.questions if questions is None else questions
    found = [
        E.detect_entities(asked, ["query_id"], "text", names, by_runs=None).select("query_id", F.lit(table).alias("source_table"), "key")
        for table, names in (("country_performance", t.countries), ("artist_performance", t.artists))
    ]
    return found[0].unionByName(found[1])


VECTORS_SQL = """{name} AS (SELECT {ids}, list(CAST(coalesce(n, 0) / norm AS FLOAT) ORDER BY i) AS v FROM (
  SELECT {ids}, i, n, sqrt(sum(coalesce(n * n, 0)) OVER (PARTITION BY {ids})) AS norm FROM (
    SELECT {ids}, i FROM {source}, range(384) r(i)) LEFT JOIN (
    SELECT {ids}, CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) % 384 AS i, count(*) AS n
    FROM (SELECT {ids}, unnest(regexp_extract_all(lower({text}), '[a-z0-9'']+')) AS w FROM {source}) GROUP BY ALL) USING ({ids}, i))
  GROUP BY {ids})"""


@query(
    "retrieve_per_entity_by_vector",
    over_silver(
        f"""{TX.QUESTIONS_CTE}{CHUNKS_CTE.replace(ARTISTS_RANKED, '')},
        {VECTORS_SQL.format(name='qv', ids='question_id', source='questions', text='text')},
        scoped_chunks AS (SELECT * FROM chunks WHERE source_table IN ('country_performance', 'artist_performance')),
        {VECTORS_SQL.format(name='cv', ids='source_table, source_key', source='scoped_chunks', text='chunk_text')},
        near AS (SELECT question_id AS query_id, key AS entity_key, source_table, source_key, round(list_distance(CAST(qv.v AS DOUBLE[]), CAST(cv.v AS DOUBLE[])), 6) AS distance
          FROM (SELECT DISTINCT question_id, key, kind FROM mentions) JOIN qv USING (question_id) JOIN cv ON source_table = kind || '_performance' AND starts_with(source_key, key || '|'))
        SELECT query_id, entity_key, source_table, source_key, distance,
          CAST(row_number() OVER (PARTITION BY query_id, source_table, entity_key ORDER BY distance, source_key) - 1 AS INT) AS rank
        FROM near QUALIFY rank < 5"""
    ),
)
def retrieve_per_entity_by_vector(spark, sf):
    t = served(spark, sf)
    return R.retrieve_per_entity(t.chunks, t.questions, _mentions(t))


#: Vector and keyword ranks within each entity that a question names, fused and reranked.
ENTITY_SQL = f"""{TX.QUESTIONS_CTE}{CHUNKS_CTE.replace(ARTISTS_RANKED, '')},
    {VECTORS_SQL.format(name='qv', ids='question_id', source='questions', text='text')},
    scoped_chunks AS (SELECT * FROM chunks WHERE source_table IN ('country_performance', 'artist_performance')),
    {VECTORS_SQL.format(name='cv', ids='source_table, source_key', source='scoped_chunks', text='chunk_text')},
    named AS (SELECT DISTINCT question_id AS query_id, key AS entity_key, kind || '_performance' AS source_table FROM mentions),
    indexed AS MATERIALIZED (SELECT source_table, source_key, regexp_replace(source_key, '[|][^|]*$', '') AS entity_key, chunk_text,
      {terms_sql('chunk_text')} AS terms, list_distinct(regexp_extract_all(lower(chunk_text), '[a-z0-9'']+')) AS said FROM chunks),
    pairs AS MATERIALIZED (SELECT query_id, entity_key, source_table, source_key FROM named JOIN indexed USING (source_table, entity_key)),
    near AS (SELECT pairs.*, round(list_distance(CAST(qv.v AS DOUBLE[]), CAST(cv.v AS DOUBLE[])), 6) AS distance
      FROM pairs JOIN qv ON qv.question_id = query_id JOIN cv USING (source_table, source_key)),
    by_vector AS (SELECT *, row_number() OVER (PARTITION BY query_id, source_table, entity_key ORDER BY distance, source_key) - 1 AS r1 FROM near QUALIFY r1 < 20),
    parts AS (SELECT question_id AS query_id, unnest(string_split_regex(lower(text), '\\s+or\\s+')) AS part FROM questions),
    wanted AS (SELECT query_id, part, list_distinct({terms_sql('part')}) AS terms FROM parts),
    df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(terms)) AS term FROM indexed) GROUP BY term),
    stats AS (SELECT count(*) AS n, avg(len(terms)) AS mean FROM indexed),
    held AS (SELECT pairs.*, part, wanted.terms AS asked, indexed.terms AS held FROM pairs JOIN wanted USING (query_id) JOIN indexed USING (source_table, source_key)
      WHERE len(wanted.terms) > 0 AND list_has_all(indexed.terms, wanted.terms)),
    each_part AS (SELECT query_id, entity_key, source_table, source_key, part, round(sum(ln(1 + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.2 AS DOUBLE)
        / (tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len(held) / mean))), 6) AS bm25
      FROM (SELECT *, len(list_filter(held, lambda w: w = term)) AS tf FROM (SELECT *, unnest(asked) AS term FROM held)) JOIN df USING (term), stats GROUP BY ALL),
    scores AS (SELECT query_id, entity_key, source_table, source_key, max(bm25) AS bm25 FROM each_part GROUP BY ALL),
    by_words AS (SELECT *, row_number() OVER (PARTITION BY query_id, source_table, entity_key ORDER BY bm25 DESC, source_key) - 1 AS r2 FROM scores QUALIFY r2 < 20),
    fused AS (SELECT query_id, entity_key, source_table, source_key, coalesce(1 / CAST(60 + r1 AS DOUBLE), 0) + coalesce(1 / CAST(60 + r2 AS DOUBLE), 0) AS rrf
      FROM by_vector FULL JOIN by_words USING (query_id, entity_key, source_table, source_key)),
    scored AS (SELECT fused.*, distance, coalesce(len(list_intersect(list_distinct(regexp_extract_all(lower(text), '[a-z0-9'']+')), said))
        / CAST(nullif(len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9'']+'))), 0) AS DOUBLE), 0) AS score
      FROM fused JOIN near USING (query_id, entity_key, source_table, source_key) JOIN indexed USING (source_table, source_key, entity_key) JOIN questions ON question_id = query_id)
    SELECT query_id, entity_key, source_table, source_key, distance, round(score, 9) AS score,
      CAST(row_number() OVER (PARTITION BY query_id, source_table, entity_key ORDER BY score DESC, rrf DESC, source_key) - 1 AS INT) AS rank
    FROM scored QUALIFY rank < 5"""


def chunk_store(spark, sf):
    chunks = served(spark, sf).chunks
    return stored(spark, sf, "chunk_store", lambda path: CS.store_chunks(chunks, path))


@query("retrieve_per_entity", over_silver(ENTITY_SQL))
def retrieve_per_entity(spark, sf):
    t = served(spark, sf)
    return CS.retrieve_in_entities(chunk_store(spark, sf), t.questions, _mentions(t)).withColumn("score", F.round("score", 9))


#: Questions routed by exact evidence, each searched in its table (or all of them) by vector and words, fused and reranked.
HYBRID_CTE = f"""{TX.QUESTIONS_CTE}{CHUNKS_CTE.replace(ARTISTS_RANKED, '')}, {TX.ROUTED_CTE},
    routes AS (SELECT question_id AS query_id, source_table AS scope FROM routed),
    {VECTORS_SQL.format(name='qv', ids='question_id', source='questions', text='text')},
    {VECTORS_SQL.format(name='cv', ids='source_table, source_key', source='chunks', text='chunk_text')},
    qd AS MATERIALIZED (SELECT question_id, CAST(v AS DOUBLE[]) AS v FROM qv), cd AS MATERIALIZED (SELECT source_table, source_key, CAST(v AS DOUBLE[]) AS v FROM cv),
    near AS MATERIALIZED (SELECT query_id, cd.source_table, source_key, round(list_distance(qd.v, cd.v), 6) AS distance
      FROM routes JOIN qd ON question_id = query_id JOIN cd ON scope IS NULL OR scope = cd.source_table),
    by_vector AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, source_table, source_key) - 1 AS r1 FROM near QUALIFY r1 < 20),
    indexed AS MATERIALIZED (SELECT source_table, source_key, {terms_sql('chunk_text')} AS terms,
      list_distinct(regexp_extract_all(lower(chunk_text), '[a-z0-9'']+')) AS said FROM chunks),
    parts AS (SELECT question_id AS query_id, unnest(string_split_regex(lower(text), '\\s+or\\s+')) AS part FROM questions),
    wanted AS (SELECT query_id, part, list_distinct({terms_sql('part')}) AS terms FROM parts),
    asked AS (SELECT query_id, part, unnest(terms) AS term, len(terms) AS size FROM wanted),
    tf AS MATERIALIZED (SELECT source_table, source_key, term, count(*) AS tf, any_value(held) AS held
      FROM (SELECT source_table, source_key, unnest(terms) AS term, len(terms) AS held FROM indexed) GROUP BY source_table, source_key, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    stats AS (SELECT count(*) AS n, avg(len(terms)) AS mean FROM indexed),
    hit AS (SELECT query_id, part, source_table, source_key, count(*) AS matched, any_value(size) AS size,
      sum(ln(1 + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.2 AS DOUBLE)
        / (tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * held / mean))) AS bm25
      FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN routes USING (query_id), stats WHERE scope IS NULL OR scope = source_table GROUP BY ALL),
    words_found AS (SELECT query_id, source_table, source_key, max(round(bm25, 6)) AS bm25 FROM hit WHERE matched = size GROUP BY ALL),
    by_words AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bm25 DESC, source_table, source_key) - 1 AS r2 FROM words_found QUALIFY r2 < 20),
    fused AS (SELECT query_id, source_table, source_key, coalesce(1 / CAST(60 + r1 AS DOUBLE), 0) + coalesce(1 / CAST(60 + r2 AS DOUBLE), 0) AS rrf
      FROM by_vector FULL JOIN by_words USING (query_id, source_table, source_key)),
    scored AS (SELECT fused.*, coalesce(len(list_intersect(list_distinct(regexp_extract_all(lower(text), '[a-z0-9'']+')), said))
        / CAST(nullif(len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9'']+'))), 0) AS DOUBLE), 0) AS score
      FROM fused JOIN indexed USING (source_table, source_key) JOIN questions ON question_id = query_id),
    ranked AS MATERIALIZED (SELECT query_id, source_table, source_key, round(score, 9) AS score,
      CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, rrf DESC, source_table, source_key) - 1 AS INT) AS rank FROM scored QUALIFY rank < 5)"""
#: The gate on each question's best chunk.
GATED_CTE = f""", gated AS (SELECT question_id AS query_id, r.source_table, confident, distance AS top1_distance,
      CASE WHEN NOT confident AND (distance IS NULL OR distance > CAST({K.NO_MATCH_DISTANCE} AS DOUBLE)) THEN 'no data' ELSE 'answer' END AS outcome
    FROM routed_flags r LEFT JOIN (SELECT * FROM ranked WHERE rank = 0) b ON b.query_id = question_id
      LEFT JOIN near n ON n.query_id = question_id AND n.source_table = b.source_table AND n.source_key = b.source_key)"""


def _routed(t, fuzzy=False):
    return E.route_table(t.questions.select("query_id", "text"), ["query_id"], "text", t.countries, t.artists, fuzzy)


def _searched(t, routed):
    """(chunks, questions) with the routed table as scope."""
    scoped = t.questions.join(routed.select("query_id", F.col("source_table").alias("scope")), "query_id")
    return t.chunks.withColumn("scope", F.col("source_table")), scoped


def routed_hybrid(spark, sf):
    """Hybrid search of every question in its routed table, written once."""
    t = served(spark, sf)
    return stored(spark, sf, "routed_hybrid", lambda path: _write(R.hybrid_search(*_searched(t, _routed(t))), path))


def _write(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@query("hybrid_search", over_silver(f"{HYBRID_CTE} SELECT * FROM ranked"))
def hybrid_search(spark, sf):
    return routed_hybrid(spark, sf).withColumn("score", F.round("score", 9))


@query("confidence_gate", over_silver(f"{HYBRID_CTE}{GATED_CTE} SELECT * FROM gated"))
def confidence_gate(spark, sf):
    """The gate on what the answer would use: the best chunk of the routed, reranked search."""
    t = served(spark, sf)
    return R.confidence_gate(_routed(t), R.top1_distance(routed_hybrid(spark, sf), t.questions, t.chunks))


@query("confidence_gate_fuzzy")
def confidence_gate_fuzzy(spark, sf):
    """Fuzzy names route too, but only as weak evidence, so the distance decides."""
    t = served(spark, sf)
    routed = _write(_routed(t, fuzzy=True), work_dir(spark, "routed"))
    ranked = R.hybrid_search(*_searched(t, routed))
    return R.confidence_gate(routed, R.top1_distance(ranked, t.questions, t.chunks))


@query(
    "retrieval_eval",
    over_silver(
        f"""{HYBRID_CTE}{GATED_CTE}, listed AS (SELECT query_id, string_agg(source_table || ':' || source_key, ', ' ORDER BY rank) AS top_chunks FROM ranked GROUP BY query_id),
        five AS (SELECT query_id, {', '.join(f'max(CASE WHEN r1 = {i} THEN distance END) AS distance_{i + 1}' for i in range(5))} FROM by_vector GROUP BY query_id)
        SELECT gated.*, top_chunks, {', '.join(f'distance_{i + 1}' for i in range(5))} FROM gated LEFT JOIN listed USING (query_id) LEFT JOIN five USING (query_id)"""
    ),
)
def retrieval_eval(spark, sf):
    """Per question: route, five chunks, the gate's outcome and the five nearest distances within the routed table."""
    t = served(spark, sf)
    routed, ranked = _routed(t), routed_hybrid(spark, sf)
    near = R.knn_exact(*_searched(t, routed), K.TOP_K, in_blocks=None)
    return R.retrieval_eval(routed, ranked, R.top1_distance(ranked, t.questions, t.chunks), near)


@query("retrieval_eval_runs")
def retrieval_eval_runs(spark, sf):
    """Vector search alone against hybrid search over the same routed questions."""
    t = served(spark, sf)
    routed = _routed(t)
    runs = [
        R.retrieval_eval(routed, ranked, R.top1_distance(ranked, t.questions, t.chunks))
        for ranked in (R.knn_exact(*_searched(t, routed), K.TOP_K, in_blocks=None), routed_hybrid(spark, sf))
    ]
    return R.compare_runs(*runs)


# --- answers to all questions ---------------------------------------------------------------

LABELLED_CTE = TX.LABEL_SQL.replace("\nSELECT question_id, text", ",\nlabelled AS (SELECT question_id, tab") + ")"
ANSWERS_SQL = f"""{TX.QUESTIONS_CTE}{CHUNKS_CTE.replace(ARTISTS_RANKED, '')}, {LABELLED_CTE},
facts AS (SELECT 'country_performance' AS t, country_name AS key, year, country_name AS name, CAST(sum(total_streams) AS BIGINT) AS total, 0 AS hit
    FROM country_performance GROUP BY ALL
  UNION ALL SELECT 'artist_performance', artist_uri, year, min(artist_name), CAST(sum(total_streams) AS BIGINT), 0 FROM artist_performance GROUP BY ALL
  UNION ALL SELECT 'label_performance_enhanced', standardized_label, year, standardized_label, CAST(sum(total_streams) AS BIGINT), 0 FROM labels_month GROUP BY ALL
  UNION ALL SELECT 'kpi_song', uri, year, min(coalesce(track_name, uri)), CAST(sum(total_streams) AS BIGINT), max(is_hit) FROM kpi LEFT JOIN track_catalog USING (uri) GROUP BY ALL),
named AS (SELECT DISTINCT question_id, kind || '_performance' AS t, key FROM mentions),
tabled AS (SELECT *, CASE WHEN intent = 'sum' AND tab IS NULL THEN
    CASE WHEN question_id IN (SELECT question_id FROM named WHERE t = 'country_performance') THEN 'country_performance'
      WHEN question_id IN (SELECT question_id FROM named WHERE t = 'artist_performance') THEN 'artist_performance' ELSE target_table END
    ELSE target_table END AS t FROM labelled WHERE intent <> 'none' AND question_id NOT LIKE 'turn|%'),
own AS (SELECT question_id, t, key, count(*) OVER (PARTITION BY question_id) AS n, intent FROM tabled JOIN named USING (question_id, t)),
chosen AS MATERIALIZED (SELECT question_id, t, key FROM own WHERE n >= CASE WHEN intent IN ('superlative', 'trend') THEN 2 WHEN intent = 'sum' THEN 1 END),
general AS MATERIALIZED (SELECT * FROM tabled WHERE question_id NOT IN (SELECT question_id FROM chosen)),
cases AS MATERIALIZED (SELECT DISTINCT intent, t, target_year, previous_year, ascending FROM general),
per_key AS (SELECT t, key, min(name) AS name, CAST(sum(total) AS BIGINT) AS total, max(hit) AS hit FROM facts GROUP BY ALL),
answered AS (
  SELECT c.*, 1 AS position, NULL AS key, NULL AS name, CASE intent
    WHEN 'sum' THEN (SELECT CAST(coalesce(sum(total), 0) AS BIGINT) FROM facts f WHERE f.t = c.t AND (c.target_year IS NULL OR f.year = c.target_year))
    WHEN 'count' THEN (SELECT count(DISTINCT key) FROM facts f WHERE f.t = c.t)
    ELSE (SELECT count(DISTINCT key) FROM facts f WHERE f.t = c.t AND hit = 1 AND (c.target_year IS NULL OR f.year = c.target_year)) END AS value
    FROM cases c WHERE intent IN ('sum', 'count', 'count_hits')
  UNION ALL SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.t, ascending ORDER BY CASE WHEN ascending THEN total ELSE -total END, key) AS position, key, name, total
    FROM cases c JOIN per_key p ON p.t = c.t WHERE intent = 'superlative') WHERE position <= 5
  UNION ALL SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.t, target_year, previous_year, ascending
      ORDER BY CASE WHEN ascending THEN 1 ELSE -1 END * (a.total - coalesce(b.total, 0)), a.key) AS position, a.key, a.name, a.total - coalesce(b.total, 0)
    FROM cases c JOIN facts a ON a.t = c.t AND a.year = target_year LEFT JOIN facts b ON b.t = a.t AND b.key = a.key AND b.year = previous_year
    WHERE intent = 'trend') WHERE position <= 5),
keyed AS (SELECT question_id, t, key, intent, ascending, target_year, previous_year, min(name) AS name, sum(total) AS s,
    sum(total) FILTER (WHERE year = target_year) AS a, sum(total) FILTER (WHERE year = previous_year) AS b
  FROM chosen JOIN tabled USING (question_id, t) LEFT JOIN facts USING (t, key) GROUP BY ALL),
listed AS (SELECT *, CASE intent WHEN 'trend' THEN a - coalesce(b, 0) ELSE s END AS v FROM keyed WHERE intent <> 'sum')
SELECT question_id, g.intent, g.t AS source_table, CAST(position AS INT) AS position, key, name, CAST(value AS BIGINT) AS value
  FROM general g JOIN answered c ON c.intent = g.intent AND c.t = g.t AND c.target_year IS NOT DISTINCT FROM g.target_year
    AND c.previous_year IS NOT DISTINCT FROM g.previous_year AND c.ascending = g.ascending
UNION ALL SELECT question_id, 'sum', t, 1, NULL, NULL, CAST(coalesce(sum(CASE WHEN target_year IS NULL THEN s ELSE a END), 0) AS BIGINT) FROM keyed WHERE intent = 'sum' GROUP BY question_id, t
UNION ALL SELECT question_id, intent, t, CAST(row_number() OVER (PARTITION BY question_id ORDER BY CASE WHEN ascending THEN v ELSE -v END, key) AS INT), key, name, CAST(v AS BIGINT)
  FROM listed WHERE v IS NOT NULL"""


@query("answer_questions", over_silver(ANSWERS_SQL))
def answer_questions(spark, sf):
    t = served(spark, sf, vectors=False)
    songs = t.gold["kpi_song"].join(t.gold["track_catalog"].select("uri", "track_name"), "uri", "left")
    no_hit = F.lit(0)
    facts = A.yearly_facts(
        {
            "country_performance": (t.gold["country_performance"], "country_name", F.col("country_name"), no_hit),
            "artist_performance": (t.gold["artist_performance_ranked"], "artist_uri", F.col("artist_name"), no_hit),
            "label_performance_enhanced": (t.gold["label_performance_enhanced"], "standardized_label", F.col("standardized_label"), no_hit),
            "kpi_song": (songs, "uri", F.coalesce("track_name", "uri"), F.col("is_hit")),
        }
    )
    # Facts, labels and mentions are read by every kind of answer, so each is worked out once. What asks for nothing needs no mentions.
    facts = _write(facts, work_dir(spark, "yearly_facts"))
    asked = t.questions.select(F.col("query_id").alias("question_id"), "text")
    labelled = _write(T.label_turns(asked).where("intent <> 'none'"), work_dir(spark, "labelled"))
    mentions = _mentions(t, labelled.select(F.col("question_id").alias("query_id"), "text"))
    mentions = _write(mentions.withColumnRenamed("query_id", "question_id"), work_dir(spark, "mentions"))
    return A.answers(A.named_targets(labelled, mentions), mentions, facts)
