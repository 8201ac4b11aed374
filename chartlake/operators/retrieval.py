"""Nearest neighbours, keyword search, rank fusion and gating over a chunk table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions.text import INDEX_WORD, stem, words
from chartlake.functions.vectors import l2_distance, term_overlap
from chartlake.operators.blocks import DIGITS, nearest_in_blocks
from chartlake.operators.windows import top_k_per_group

QUERY_BYTES = 64 << 20  # a larger query side is not broadcast
QUERY_BLOCK = 32_768
CORPUS_BLOCK = 524_288  # rows are streamed, so this bounds no memory

CHUNK = ("source_table", "source_key")


def candidate_budget(k: int = K.TOP_K) -> int:
    return max(4 * k, 15)


# --- exact nearest neighbours -------------------------------------------------------------


def matrix(column) -> np.ndarray:
    """A list column of one Arrow batch, or a series of arrays, as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.Array):
        if not len(column):
            return np.zeros((0, 0))
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype("float64")
    return np.array([np.asarray(v, dtype="float64") for v in column])


class Nearest:
    """The k nearest corpus rows per query row, over any number of batches of one task.

    The product form of the distance, in single precision, picks candidates with some slack: in the first
    batch against the batch's own k-th best, later against the k-th best so far. Their distances are then
    worked out from the differences in double precision, and only queries with candidates are merged.

    Word counts give many equal distances, so a query may have far more candidates than k: where a step has many, their distances
    come from a product in double precision, and only those near a rounding edge from the differences; k a query are kept at once.
    """

    STEP = 256  # query rows per matrix product
    PAIRS = 2_048  # pairs whose differences are held at once

    def __init__(self, queries: pd.DataFrame, vectors: np.ndarray, keys: list[str], k: int):
        self.ids, self.q, self.keys, self.k = queries["query_id"].to_numpy(dtype=object), vectors, keys, k
        self.q32, self.q2 = vectors.astype("float32"), (vectors * vectors).sum(axis=1).astype("float32")
        self.bound = np.full(len(vectors), np.inf)
        self.best: pd.DataFrame | None = None
        self.groups = None
        if "scope" in queries:
            scope = queries["scope"].to_numpy(dtype=object)
            rows = pd.Series(np.arange(len(scope)))
            free = np.array([x is None for x in scope], dtype=bool)
            self.groups = (rows[free].to_numpy(), {v: at.to_numpy() for v, at in rows[~free].groupby(scope[~free])})

    def add(self, frame: pd.DataFrame, c: np.ndarray, asking: np.ndarray | None = None) -> None:
        """Take in one batch, for the queries asking (a mask) if given; a query with a scope sees only corpus rows of that scope."""
        if not len(frame) or not len(self.q):
            return
        # In the order of the keys, the first of equal distances are the ones to keep; a key that comes twice is left to the merge.
        order = frame[self.keys].reset_index(drop=True).sort_values(self.keys, kind="stable").index.to_numpy()
        frame, c = frame.iloc[order].reset_index(drop=True), c[order]
        self.cut = not frame.duplicated(self.keys).any()
        of = lambda rows: rows if asking is None else rows[asking[rows]]
        if self.groups is None:
            found = self._candidates(of(np.arange(len(self.q))), np.arange(len(c)), c)
        else:
            free, scoped = self.groups
            found = self._candidates(of(free), np.arange(len(c)), c) if len(free) else []
            for value, at in pd.Series(np.arange(len(c))).groupby(frame["scope"].to_numpy(dtype=object)).indices.items():
                if value in scoped:
                    found += self._candidates(of(scoped[value]), at, c[at])
        if found:
            rows, cols, distances = (np.concatenate(x) for x in zip(*found))
            new = frame[self.keys].iloc[cols].reset_index(drop=True)
            new["_q"], new["distance"] = rows, distances
            self._merge(new)

    def _candidates(self, rows: np.ndarray, cols: np.ndarray, c: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        found = []
        c32, c2 = c.astype("float32"), (c * c).sum(axis=1).astype("float32")
        for start in range(0, len(rows), self.STEP):
            at = rows[start : start + self.STEP]
            d = self.q2[at, None] + c2[None, :] - 2.0 * (self.q32[at] @ c32.T)
            limit = (self.bound[at] + 10.0**-DIGITS) ** 2
            unbound = ~np.isfinite(limit)
            if unbound.any() and d.shape[1] > self.k:
                limit[unbound] = np.partition(d[unbound], self.k - 1, axis=1)[:, self.k - 1]
            # Rounding in single precision grows with the width.
            slack = np.finfo("float32").eps * (c.shape[1] + 8) * (1.0 + self.q2[at] + c2.max())
            r, k = np.nonzero(d <= (limit + slack)[:, None])
            if len(r):
                exact = self._exact(at, r, k, c)
                keep = exact <= self.bound[at[r]]
                r, k, exact = r[keep], k[keep], exact[keep]
                if self.cut and len(r):
                    order = np.lexsort((k, exact, r))
                    r, k, exact = r[order], k[order], exact[order]
                    starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                    place = np.arange(len(r)) - np.repeat(starts, np.diff(np.r_[starts, len(r)]))
                    r, k, exact = r[place < self.k], k[place < self.k], exact[place < self.k]
                found.append((at[r], cols[k], exact))
        return found

    def _exact(self, at: np.ndarray, r: np.ndarray, k: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Distances of the pairs (query at[r], row k), at DIGITS digits."""
        out, open_ = np.empty(len(r)), np.arange(len(r))
        if len(r) > self.PAIRS:
            q = self.q[at]
            q2, c2 = (q * q).sum(axis=1), (c * c).sum(axis=1)
            squares = np.maximum((q2[:, None] + c2[None, :] - 2.0 * (q @ c.T))[r, k], 0.0)
            away = np.sqrt(squares)
            # The product's own rounding; a distance that it may carry over a rounding edge is worked out again.
            off = 4.0 * np.finfo("float64").eps * (c.shape[1] + 8) * (q2[r] + c2[k])
            off = off / np.maximum(away, np.sqrt(off)) + 8.0 * np.finfo("float64").eps * (1.0 + away)
            scaled = away * 10.0**DIGITS
            out = np.round(away, DIGITS)
            open_ = np.flatnonzero(~(np.abs(scaled - np.floor(scaled) - 0.5) > off * 10.0**DIGITS))
        for start in range(0, len(open_), self.PAIRS):
            i = open_[start : start + self.PAIRS]
            out[i] = np.round(np.sqrt(((c[k[i]] - self.q[at[r[i]]]) ** 2).sum(axis=1)), DIGITS)
        return out

    def _merge(self, new: pd.DataFrame) -> None:
        rest = None
        if self.best is not None:
            touched = self.best["_q"].isin(new["_q"].unique())
            rest, new = self.best[~touched], pd.concat([self.best[touched], new], ignore_index=True)
        new = new.sort_values(["_q", "distance", *self.keys], kind="stable")
        new = new.drop_duplicates(["_q", *self.keys]).groupby("_q", sort=False).head(self.k)
        full = new.groupby("_q")["distance"].agg(["size", "max"])
        full = full[full["size"] == self.k]
        self.bound[full.index.to_numpy()] = full["max"].to_numpy()
        self.best = new if rest is None else pd.concat([rest, new], ignore_index=True)

    def result(self) -> pd.DataFrame:
        if self.best is None:
            return pd.DataFrame(columns=["query_id", *self.keys, "distance"])
        out = self.best.drop(columns="_q")
        out.insert(0, "query_id", self.ids[self.best["_q"].to_numpy()])
        return out


def query_bytes(queries: DataFrame) -> int:
    """Bytes of the query vectors as a matrix of doubles."""
    return queries.agg(F.coalesce(F.sum(F.size("embedding").cast("long") * 8), F.lit(0).cast("long"))).first()[0]


def knn_exact(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    keys: Sequence[str] = CHUNK,
    in_blocks: bool | None = False,
    query_block: int = QUERY_BLOCK,
    corpus_block: int = CORPUS_BLOCK,
) -> DataFrame:
    """The k nearest corpus rows by L2 distance for each query: query_id, keys, distance, rank from 0.

    Queries are rows (query_id, embedding[, scope]), the corpus rows (keys..., embedding[, scope]); a query
    with a scope sees only rows of that scope. Ties go to the smaller key. Rows without a vector take no part.

    The caller chooses the plan. By default the query matrix is broadcast, and every task scans its own corpus
    rows batch by batch and keeps k per query, so the corpus is not shuffled; more than QUERY_BYTES of query
    vectors are refused. With in_blocks, queries of any number are cut into blocks, past which corpus rows are
    streamed (operators/blocks.py); each task holds one block of queries, and a query with a scope meets only rows of that
    scope. in_blocks=None takes blocks where the query vectors are too large to broadcast.
    """
    scoped = "scope" in queries.columns and "scope" in corpus.columns
    columns = [*keys, "embedding", *(["scope"] if scoped else [])]
    corpus = corpus.select(*columns).filter("embedding is not null")
    asked = queries.select("query_id", "embedding", *(["scope"] if scoped else [])).filter("embedding is not null")
    large = in_blocks is not True and query_bytes(asked) > QUERY_BYTES
    if large and in_blocks is False:
        raise ValueError("the query vectors are too large to broadcast: use in_blocks")

    def met(rows: DataFrame, own: DataFrame) -> DataFrame:
        return nearest_in_blocks(rows, own, k, keys, query_block, corpus_block, _found_schema(rows, own, keys))

    if not in_blocks and not large:
        found = _scanned(corpus, asked, k, keys)
    elif not scoped:
        found = met(corpus, asked)
    else:
        own = met(corpus.filter("scope is not null"), asked.filter("scope is not null"))
        free = asked.filter("scope is null").drop("scope")
        few = in_blocks is None and query_bytes(free) <= QUERY_BYTES
        everywhere = corpus.drop("scope")
        found = own.unionByName(_scanned(everywhere, free, k, keys) if few else met(everywhere, free))
    ranked = top_k_per_group(found, ["query_id"], ["distance", *keys], k, "rank")
    return ranked.withColumn("rank", F.col("rank") - 1)


def _found_schema(corpus: DataFrame, asked: DataFrame, keys: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in corpus.schema}
    return ", ".join([f"query_id {asked.schema['query_id'].dataType.simpleString()}", *(f"{n} {types[n]}" for n in corpus.columns if n in keys), "distance double"])


def _scanned(corpus: DataFrame, asked: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """Each task's k nearest rows per query, the queries being sent to all tasks; the caller checks their size."""
    key_list = list(keys)
    local = asked.toPandas()
    q_matrix = matrix(local["embedding"]) if len(local) else np.zeros((0, 0))
    shared = corpus.sparkSession.sparkContext.broadcast((local.drop(columns="embedding"), q_matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(*shared.value, key_list, k)
        for batch in batches:
            plain = batch.select([x for x in batch.schema.names if x != "embedding"]).to_pandas()
            nearest.add(plain, matrix(batch.column(batch.schema.get_field_index("embedding"))))
        out = nearest.result()
        if len(out):
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    return corpus.mapInArrow(scan, _found_schema(corpus, asked, keys))


# --- recall and best distances -------------------------------------------------------


def recall(approximate: DataFrame, exact: DataFrame, keys: Sequence[str] = CHUNK) -> DataFrame:
    """Share of each query's exact neighbours that the approximate search found."""
    hits = approximate.select("query_id", *keys, F.lit(1).alias("_hit"))
    return (
        exact.select("query_id", *keys).join(hits, ["query_id", *keys], "left")
        .groupBy("query_id")
        .agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
    )


def top1_distance(ranked: DataFrame, queries: DataFrame, corpus: DataFrame, keys: Sequence[str] = CHUNK) -> DataFrame:
    """Distance from each query to its best-ranked chunk, whatever ranked it."""
    best = ranked.filter("rank = 0").select("query_id", *keys)
    return (
        best.join(corpus.select(*keys, F.col("embedding").alias("_c")), list(keys))
        .join(queries.select("query_id", F.col("embedding").alias("_q")), "query_id")
        .select("query_id", *keys, F.round(l2_distance(F.col("_q"), F.col("_c")), DIGITS).alias("distance"))
    )


# --- keyword search -----------------------------------------------------------------------


def index_terms(text: Column, stop_words: Sequence[str] = K.STOP_WORDS) -> Column:
    """Stemmed words without stop words, in order."""
    kept = F.filter(words(text, INDEX_WORD), lambda w: ~w.isin(*stop_words))
    return F.transform(kept, stem)


def phrase_text(text: Column) -> Column:
    """All stemmed words between blanks, for phrase tests."""
    return F.concat(F.lit(" "), F.array_join(F.transform(words(text, INDEX_WORD), stem), " "), F.lit(" "))


def with_index(corpus: DataFrame, text: str = "chunk_text") -> DataFrame:
    """The corpus with the columns keyword search works on; written with the chunks, they are made once."""
    return corpus.withColumns({"index_terms": index_terms(F.col(text)), "index_text": phrase_text(F.col(text))})


#: "or" between words, outside quotes: an even number of quotes follows.
ALTERNATIVE = '\\s+or\\s+(?=(?:[^"]*"[^"]*")*[^"]*$)'


def search_terms(queries: DataFrame, text: str, exclusions: bool = False) -> DataFrame:
    """One row per alternative of each query: terms, excluded terms, phrases.

    With exclusions, alternatives that only exclude are kept; without, they are left out. Words must all match; -word and -"phrase" exclude; "phrase" must occur as such; OR, outside quotes, starts an alternative.
    """
    split = queries.select("query_id", F.posexplode(F.split(F.lower(F.col(text)), ALTERNATIVE)).alias("alternative", "_x"))
    no_phrase = F.regexp_extract_all("_x", F.lit('(?:^|\\s)-"([^"]*)"'), F.lit(1))
    rest = F.regexp_replace("_x", '(?:^|\\s)-"[^"]*"', " ")
    phrase = F.regexp_extract_all(rest, F.lit('"([^"]*)"'), F.lit(1))
    plain = F.regexp_replace(rest, '"', " ")
    # Only a dash after a blank excludes; one inside a word does not.
    no_word = F.regexp_extract_all(plain, F.lit("(?:^|\\s)-([\\p{L}\\p{N}]+)"), F.lit(1))
    kept = F.regexp_replace(plain, "(?:^|\\s)-[\\p{L}\\p{N}]+", " ")
    texts = lambda xs: F.transform(F.filter(xs, lambda p: F.trim(p) != ""), phrase_text)
    return split.select(
        "query_id",
        "alternative",
        F.array_distinct(index_terms(kept)).alias("terms"),
        F.array_distinct(index_terms(F.array_join(no_word, " "))).alias("excluded"),
        texts(phrase).alias("phrases"),
        texts(no_phrase).alias("excluded_phrases"),
    ).filter((F.size("terms") > 0) | (F.lit(exclusions) & ((F.size("excluded") > 0) | (F.size("excluded_phrases") > 0))))


def keyword_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    text: str = "chunk_text",
    query_text: str = "text",
    keys: Sequence[str] = CHUNK,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """The k best chunks that satisfy each query, by BM25: query_id, keys, score, rank from 0.

    An alternative's candidates are the chunks that hold its rarest term; they alone are checked for the
    other terms, so a frequent term never multiplies rows. Both sides may carry a scope, as in knn_exact.
    A corpus that already has the index columns is not tokenised again.
    Ranking and stemming are our own, not a database's.
    """
    keys = list(keys)
    scoped = ["scope"] if "scope" in queries.columns and "scope" in corpus.columns else []
    wanted = search_terms(queries, query_text)
    indexed = corpus if "index_terms" in corpus.columns else with_index(corpus, text)
    docs = indexed.select(*keys, *scoped, F.col("index_terms").alias("_terms"), F.col("index_text").alias("_text"))
    stats = docs.agg(F.count(F.lit(1)).alias("_n"), F.avg(F.size("_terms")).alias("_mean"))

    # Chunk counts of the query terms only.
    needed = wanted.select(F.explode("terms").alias("term")).distinct()
    postings = docs.select(*keys, *scoped, F.explode(F.array_distinct("_terms")).alias("term")).join(needed, "term", "left_semi")
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    known = (
        wanted.select("query_id", "alternative", F.explode("terms").alias("term"), F.size("terms").alias("_size"))
        .join(frequency, "term")
        .groupBy("query_id", "alternative", "_size")
        # A query's own terms.
        .agg(F.sort_array(F.collect_list(F.struct("df", "term"))).alias("_by_df"))
        # A term found in no chunk rules the alternative out.
        .filter(F.size("_by_df") == F.col("_size"))
        .withColumn("term", F.col("_by_df")[0]["term"])
    )
    if scoped:
        known = known.join(queries.select("query_id", F.col("scope").alias("_want")), "query_id")
    candidates = known.select("query_id", "alternative", "term", "_by_df", *(["_want"] if scoped else [])).join(postings, "term")
    if scoped:
        candidates = candidates.filter(F.col("_want").isNull() | (F.col("_want") == F.col("scope")))
    checks = wanted.select("query_id", "alternative", "excluded", "phrases", "excluded_phrases")
    held = (
        candidates.select("query_id", "alternative", *keys, "_by_df")
        .join(docs.select(*keys, "_terms", "_text"), keys)
        .filter(F.forall("_by_df", lambda t: F.array_contains(F.col("_terms"), t["term"])))
        .join(checks, ["query_id", "alternative"])
        .filter(~F.arrays_overlap("_terms", "excluded"))
        .filter(F.forall("phrases", lambda p: F.col("_text").contains(p)))
        .filter(~F.exists("excluded_phrases", lambda p: F.col("_text").contains(p)))
    )

    def weight(t: Column) -> Column:
        tf = F.size(F.filter("_terms", lambda w: w == t["term"])).cast("double")
        idf = F.log(1 + (F.col("_n") - t["df"] + 0.5) / (t["df"] + 0.5))
        return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.size("_terms") / F.col("_mean")))

    # One row of corpus totals.
    scored = held.withColumn("_one", F.lit(1)).join(F.broadcast(stats.withColumn("_one", F.lit(1))), "_one").withColumn(
        "score", F.round(F.aggregate(F.transform("_by_df", weight), F.lit(0.0), lambda s, x: s + x), 6)
    )
    best = scored.groupBy("query_id", *keys).agg(F.max("score").alias("score"))
    ranked = top_k_per_group(best, ["query_id"], [F.desc("score"), *keys], k, "rank")
    return ranked.withColumn("rank", F.col("rank") - 1)


# --- fusion, reranking, gating ------------------------------------------------------------


def rrf_merge(first: DataFrame, second: DataFrame, keys: Sequence[str] = CHUNK, c: int = K.RRF_K) -> DataFrame:
    """Reciprocal rank fusion: the sum of 1 / (c + rank) over the lists that hold the chunk."""
    on = ["query_id", *keys]
    both = first.select(*on, F.col("rank").alias("_r1")).join(second.select(*on, F.col("rank").alias("_r2")), on, "full")
    term = lambda r: F.coalesce(1.0 / (c + F.col(r)), F.lit(0.0))
    return both.select(*on, (term("_r1") + term("_r2")).alias("rrf_score"))


def rerank_pairs(
    candidates: DataFrame | None,
    queries: DataFrame,
    corpus: DataFrame,
    k: int = K.TOP_K,
    score: Callable[[Column, Column], Column] = term_overlap,
    keys: Sequence[str] = CHUNK,
    text: str = "chunk_text",
    query_text: str = "text",
    within: Sequence[str] = (),
) -> DataFrame:
    """Score each (question, chunk) pair jointly and keep the best k; rank from 0.

    Ties keep the fused order where there is one, then the smaller key. Without candidates, every question meets all chunks that share its
    `within` columns, which both sides hold and a query id determines: questions and chunks are shuffled once, by these, and pairs not at all.
    """
    if candidates is None:
        prepared, of = getattr(score, "parts", (lambda x: x, score))
        asked = queries.select(*within, "query_id", prepared(F.col(query_text)).alias("_q"))
        rest = [c for c in keys if c not in within]
        pairs = asked.join(corpus.select(*within, *rest, prepared(F.col(text)).alias("_c")), list(within))
        pairs = pairs.withColumn("score", of(F.col("_q"), F.col("_c"))).drop("_q", "_c")
        ranked = top_k_per_group(pairs, [*within, "query_id"], [F.desc("score"), *keys], k, "rank")
        return ranked.select("query_id", *keys, "score", (F.col("rank") - 1).alias("rank"))
    tie = [F.desc("rrf_score")] if "rrf_score" in candidates.columns else []
    # The chunk's text, the longer one, comes last, so it isn't shuffled with the pairs.
    pairs = (
        candidates.join(queries.select("query_id", F.col(query_text).alias("_q")), "query_id")
        .join(corpus.select(*keys, F.col(text).alias("_c")), list(keys))
        .withColumn("score", score(F.col("_q"), F.col("_c")))
        .drop("_q", "_c")
    )
    ranked = top_k_per_group(pairs, ["query_id"], [F.desc("score"), *tie, *keys], k, "rank")
    return ranked.select("query_id", *keys, "score", (F.col("rank") - 1).alias("rank"))


def hybrid_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = K.TOP_K,
    score: Callable[[Column, Column], Column] = term_overlap,
    keys: Sequence[str] = CHUNK,
) -> DataFrame:
    """Vector and keyword candidates, fused and reranked; a scope narrows both sides alike."""
    budget = candidate_budget(k)
    merged = rrf_merge(
        knn_exact(corpus, queries, budget, keys, in_blocks=None), keyword_search(corpus, queries, budget, keys=keys), keys
    )
    return rerank_pairs(merged, queries, corpus, k, score, keys)


def entity_scope(table: Column, key: Column) -> Column:
    """Scope of one entity's own chunks: the table and the part of the key before the year."""
    return F.concat_ws(":", table, F.regexp_replace(key, "\\|[^|]*$", ""))


def retrieve_per_entity(
    corpus: DataFrame, queries: DataFrame, mentions: DataFrame, k: int = K.TOP_K, keys: Sequence[str] = CHUNK
) -> DataFrame:
    """A separate top k for every entity named in a question, so that none crowds out another.

    Mentions are rows (query_id, source_table, key).
    """
    scoped = corpus.withColumn("scope", entity_scope(F.col("source_table"), F.col("source_key")))
    asked = queries.join(mentions.select("query_id", "source_table", "key").distinct(), "query_id").select(
        F.to_json(F.struct("query_id", "source_table", "key")).alias("query_id"),
        "embedding", F.concat_ws(":", "source_table", "key").alias("scope"),
    )
    found = knn_exact(scoped, asked, k, keys, in_blocks=None)
    back = F.from_json("query_id", "query_id STRING, source_table STRING, key STRING")
    return found.withColumn("_q", back).select(
        F.col("_q.query_id").alias("query_id"), F.col("_q.key").alias("entity_key"), *keys, "distance", "rank"
    )


def confidence_gate(
    routed: DataFrame, top1: DataFrame, limit: float = K.NO_MATCH_DISTANCE
) -> DataFrame:
    """'no data' where the route is not confident and there is no chunk, or the best one is too far."""
    best = top1.select("query_id", F.col("distance").alias("top1_distance"))
    weak = ~F.col("confident") & (F.col("top1_distance").isNull() | (F.col("top1_distance") > limit))
    return routed.join(best, "query_id", "left").withColumn("outcome", F.when(weak, "no data").otherwise("answer"))


def retrieval_eval(
    routed: DataFrame, ranked: DataFrame, top1: DataFrame, near: DataFrame | None = None, keys: Sequence[str] = CHUNK, distances: int = K.TOP_K
) -> DataFrame:
    """One row per question: route, best chunk keys in order, top distance and gate outcome.

    near, the nearest chunks by vector (query_id, distance, rank), adds their distances as distance_1 and so on.
    """
    tops = F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(":", *keys).alias("key"))))
    listed = ranked.groupBy("query_id").agg(F.array_join(F.transform(tops, lambda t: t["key"]), ", ").alias("top_chunks"))
    out = confidence_gate(routed, top1).join(listed, "query_id", "left")
    if near is None:
        return out
    places = [F.max(F.when(F.col("rank") == i, F.col("distance"))).alias(f"distance_{i + 1}") for i in range(distances)]
    return out.join(near.groupBy("query_id").agg(*places), "query_id", "left")


def compare_runs(before: DataFrame, after: DataFrame, columns: Sequence[str] = ("source_table", "top_chunks", "outcome")) -> DataFrame:
    """Questions whose outcome differs between two runs, or that only one run holds."""
    old = before.select("query_id", *(F.col(c).alias(f"before_{c}") for c in columns))
    new = after.select("query_id", *(F.col(c).alias(f"after_{c}") for c in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    return old.join(new, "query_id", "full").withColumn("changed", ~same)
