"""A stored inverted index for keyword search, with score bounds per block of documents.

    <path>/docs/                    place, keys, [scope,] terms, text, length, block: documents numbered in the order of their keys
    <path>/postings/bucket=.../     term, block, place, part: a document's share of a term's score
    <path>/blocks/bucket=.../       term, block, n, top, n_any: how many documents of a block hold the term, the largest part among
                                    them, and how many hold it as a word that searches leave out, too

Terms are dealt to buckets by hash, so a search reads only the buckets of its terms. Documents of like length share a block, as short
ones score higher: a block's bounds tell more. A search adds up the bounds of the blocks that hold all terms, scores the most promising
blocks until k documents may be found, and then only those blocks whose bound can still enter the k best. Results are exact, and the
same as keyword_search's, which works the terms out anew each time.

An alternative that only excludes finds all other documents, with score 0 in the order of their keys. Alternatives that exclude the same
are worked out once. What they exclude is first only counted, by runs of PLACES documents; the shortest row of runs from the first on that
is sure to hold k others is then looked at, and no document behind it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlake.operators.retrieval import CHUNK, search_terms, with_index
from chartlake.operators.windows import top_k_per_group
from chartlake.session import work_dir

BUCKETS = 64
BLOCK_DOCS = 1_024
PLACES = 1_024
LENGTH_CLASSES = 256
K1, B = 1.2, 0.75
DIGITS = 6
COUNTED = 256  # documents whose words are counted at once
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
POSTINGS = "term string, block long, place long, part double, bucket int"
BLOCKS = "term string, block long, n long, top double, n_any long, bucket int"


@dataclass(frozen=True)
class KeywordIndex:
    docs: DataFrame
    postings: DataFrame
    blocks: DataFrame
    stats: DataFrame
    keys: tuple[str, ...]
    scoped: bool


def _bucket(term: str = "term") -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _written(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    """df written and read again; the shuffle files of the write are deleted as it ends."""
    spread = df.hint("rebalance", *map(F.col, partitions)) if partitions else df
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        spread.write.partitionBy(*partitions).parquet(path)
    finally:
        conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, block, place, length, tf) of docs (block, place, length, terms, text): a document's words are counted where it lies, not shuffled.

    Words that a search leaves out are listed too, so that every phrase can be found; they add nothing to a score.
    """
    words = F.filter(F.split(F.trim("text"), " "), lambda w: w != "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, COUNTED):
                part, sizes, terms, counts = batch.slice(s, COUNTED), [], [], []
                for kept, every in zip(part.column(3).to_pylist(), part.column(4).to_pylist()):
                    own = Counter(kept)
                    own.update(dict.fromkeys(set(every or ()) - own.keys(), 0))
                    sizes.append(len(own))
                    terms += own.keys()
                    counts += own.values()
                at = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                block, place, length = (part.column(c).take(at) for c in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), block, place, length, pa.array(counts, pa.float64())], names=["term", "block", "place", "length", "tf"])

    rows = docs.select("block", "place", "length", "terms", words.alias("words"))
    return rows.mapInArrow(run, "term string, block long, place long, length int, tf double")


def _placed(docs: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """docs with place, their number in the order of the keys, from 0."""
    ordered = docs.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    written = _written(ordered, path)
    part = F.shiftright("_at", 33)
    counts = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    # One row for each task of the sort.
    before = counts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    numbered = written.withColumn("_part", part).join(F.broadcast(before), "_part")
    return numbered.withColumn("place", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")


def build_keyword_index(
    corpus: DataFrame, path: str, keys: Sequence[str] = CHUNK, text: str = "chunk_text", block_docs: int = BLOCK_DOCS
) -> KeywordIndex:
    """Write the corpus (keys, text[, scope]) as an index. Null texts hold no term; rows are told apart by their place."""
    keys = list(keys)
    scoped = "scope" in corpus.columns
    indexed = corpus if "index_terms" in corpus.columns else with_index(corpus, text)
    docs = indexed.select(
        *keys, *(["scope"] if scoped else []), F.coalesce("index_terms", F.array().cast("array<string>")).alias("terms"),
        F.col("index_text").alias("text"), F.coalesce(F.size("index_terms"), F.lit(0)).alias("length"),
    )
    placed = _placed(docs, keys, f"{path}/ordered")
    # Documents without a text count as documents, but have no length.
    lengths = F.when(F.col("text").isNotNull(), F.col("length"))
    stats = _written(placed.agg(F.count(F.lit(1)).alias("n"), F.avg(lengths).alias("mean")), f"{path}/stats")
    total = stats.first()["n"]
    # Classes of like length, and within a class as many blocks as keep to block_docs.
    steps = [k / LENGTH_CLASSES for k in range(1, LENGTH_CLASSES)]
    cuts = placed.agg(F.array_distinct(F.percentile_approx("length", F.array(*map(F.lit, steps)), 10_000)).alias("_cuts"), F.max(F.lit(1)).alias("_one"))
    classed = placed.withColumn("_one", F.lit(1)).join(F.broadcast(cuts), "_one").withColumn(
        "_class", F.size(F.filter("_cuts", lambda c: c < F.col("length")))
    ).drop("_one", "_cuts")
    sizes = classed.groupBy("_class").agg(F.ceil(F.count(F.lit(1)) / block_docs).cast("int").alias("_parts"))
    own = F.pmod(F.xxhash64("place"), F.col("_parts")) * LENGTH_CLASSES + F.col("_class")
    written = _written(classed.join(F.broadcast(sizes), "_class").withColumn("block", own.cast("long")).drop("_class", "_parts"), f"{path}/docs")

    counted = term_counts(written)
    mean = float(stats.first()["mean"] or 1.0) or 1.0
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    postings = counted.select("term", "block", "place", part.alias("part"), _bucket().alias("bucket"))
    postings = _written(postings, f"{path}/postings", "bucket")
    blocks = postings.groupBy("bucket", "term", "block").agg(
        F.count_if(F.col("part") > 0).alias("n"), F.max("part").alias("top"), F.count(F.lit(1)).alias("n_any")
    )
    _written(blocks.select("term", "block", "n", "top", "n_any", "bucket"), f"{path}/blocks", "bucket")
    about = corpus.sparkSession.createDataFrame([(keys, scoped, total)], "keys array<string>, scoped boolean, n long")
    about.coalesce(1).write.parquet(f"{path}/about")
    return open_keyword_index(corpus.sparkSession, path)


def open_keyword_index(spark: SparkSession, path: str) -> KeywordIndex:
    about = spark.read.parquet(f"{path}/about").first()
    read = {name: spark.read.parquet(f"{path}/{name}") for name in ("docs", "stats")}
    read |= {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in (("postings", POSTINGS), ("blocks", BLOCKS))}
    return KeywordIndex(**read, keys=tuple(about["keys"]), scoped=about["scoped"])


def _saved(df: DataFrame, name: str) -> DataFrame:
    return _written(df, work_dir(df.sparkSession, name))


def _of_terms(table: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of some terms (term, bucket); only their buckets, at most BUCKETS numbers, are read."""
    wanted = [r[0] for r in terms.select("bucket").distinct().collect()]
    return table.filter(F.col("bucket").isin(wanted)).join(terms.select("term", "bucket").distinct(), ["bucket", "term"], "left_semi")


def _alternatives(index: KeywordIndex, queries: DataFrame, query_text: str) -> DataFrame:
    wanted = search_terms(queries, query_text, exclusions=True)
    scope = F.col("scope").cast("string") if index.scoped and "scope" in queries.columns else F.lit(None).cast("string")
    return wanted.join(queries.select("query_id", scope.alias("_want")), "query_id")


def _candidates(index: KeywordIndex, wanted: DataFrame) -> DataFrame:
    """(query_id, alternative, block, term, n, bound, ...): the blocks that hold all terms of an alternative."""
    asked = wanted.select("query_id", "alternative", F.explode("terms").alias("term"), F.size("terms").alias("_size")).withColumn("bucket", _bucket())
    blocks = _of_terms(index.blocks, asked).filter("n > 0")
    total = F.broadcast(index.stats.select(F.col("n").alias("_n"), F.lit(1).alias("_one")))  # one row
    known = blocks.groupBy("bucket", "term").agg(F.sum("n").alias("df")).withColumn("_one", F.lit(1)).join(total, "_one")
    idf = F.log(1 + (F.col("_n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    known = known.select("bucket", "term", "df", idf.alias("idf"))
    # An alternative's own terms; one that no document holds rules it out.
    by_df = F.sort_array(F.collect_list(F.struct("df", "term", "idf")))
    terms = asked.join(known, ["bucket", "term"]).groupBy("query_id", "alternative", "_size").agg(by_df.alias("_by_df"))
    terms = terms.filter(F.size("_by_df") == F.col("_size"))
    held = (
        terms.select("query_id", "alternative", "_size", F.explode("_by_df").alias("t"), F.col("_by_df")[0]["term"].alias("_rarest"))
        .select("query_id", "alternative", "_size", "_rarest", F.col("t.term").alias("term"), F.col("t.idf").alias("idf"))
        .join(blocks.select("term", "block", "n", "top"), "term")
        .groupBy("query_id", "alternative", "_size", "_rarest", "block")
        .agg(F.count(F.lit(1)).alias("_held"), F.sum(F.col("idf") * F.col("top")).alias("bound"), F.max(F.when(F.col("term") == F.col("_rarest"), F.col("n"))).alias("n"))
        .filter(F.col("_held") == F.col("_size"))
    )
    return held.select("query_id", "alternative", F.col("_rarest").alias("term"), "block", "n", "bound").join(
        terms.select("query_id", "alternative", "_by_df"), ["query_id", "alternative"]
    )


def _scored(index: KeywordIndex, chosen: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, place, keys, score) of the documents in the chosen blocks that satisfy an alternative."""
    postings = _of_terms(index.postings, chosen.select("term", _bucket().alias("bucket")))
    held = chosen.select("query_id", "alternative", "term", "block", "_by_df").join(postings.select("term", "block", "place"), ["term", "block"])
    checks = wanted.select("query_id", "alternative", "excluded", "phrases", "excluded_phrases", "_want")
    rows = held.join(index.docs, "place").join(checks, ["query_id", "alternative"])
    scope = F.col("_want").isNull() | (F.col("_want") == F.col("scope").cast("string")) if index.scoped else F.lit(True)
    rows = (
        rows.filter(scope)
        .filter(F.forall("_by_df", lambda t: F.array_contains(F.col("terms"), t["term"])))
        .filter(~F.arrays_overlap("terms", "excluded"))
        .filter(F.forall("phrases", lambda p: F.col("text").contains(p)))
        .filter(~F.exists("excluded_phrases", lambda p: F.col("text").contains(p)))
    )
    mean = F.broadcast(index.stats.select(F.col("mean").alias("_mean"), F.lit(1).alias("_one")))  # one row

    def weight(t: Column) -> Column:
        tf = F.size(F.filter("terms", lambda w: w == t["term"])).cast("double")
        return t["idf"] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.size("terms") / F.col("_mean")))

    score = F.round(F.aggregate(F.transform("_by_df", weight), F.lit(0.0), lambda s, x: s + x), DIGITS)
    return rows.withColumn("_one", F.lit(1)).join(mean, "_one").select("query_id", "place", *index.keys, score.alias("score"))


def _members(index: KeywordIndex, only: DataFrame) -> DataFrame:
    """(query_id, alternative, place) of the documents that an alternative excludes."""
    words = only.select("query_id", "alternative", F.explode("excluded").alias("term")).withColumn("bucket", _bucket())
    # A document holds an excluded word if the word counts there; words left out of searches exclude nothing.
    by_word = words.join(_of_terms(index.postings, words).filter("part > 0"), ["bucket", "term"]).select("query_id", "alternative", "place")
    phrases = only.select("query_id", "alternative", F.explode("excluded_phrases").alias("_phrase"))
    parts = phrases.withColumn("_words", F.array_distinct(F.split(F.trim("_phrase"), " ")))
    each = parts.select("query_id", "alternative", "_phrase", F.size("_words").alias("_size"), F.explode("_words").alias("term")).withColumn("bucket", _bucket())
    counts = _of_terms(index.blocks, each).groupBy("bucket", "term").agg(F.sum("n_any").alias("df"))
    rarest = each.join(counts, ["bucket", "term"]).groupBy("query_id", "alternative", "_phrase", "_size").agg(
        F.count(F.lit(1)).alias("_known"), F.min(F.struct("df", "term")).alias("t")
    ).filter(F.col("_known") == F.col("_size")).select("query_id", "alternative", "_phrase", F.col("t.term").alias("term")).withColumn("bucket", _bucket())
    by_phrase = rarest.join(_of_terms(index.postings, rarest), ["bucket", "term"]).join(index.docs.select("place", "text"), "place")
    by_phrase = by_phrase.filter(F.col("text").contains(F.col("_phrase"))).select("query_id", "alternative", "place")
    # A document that several words or phrases exclude comes several times.
    return by_word.unionByName(by_phrase)


def _first_places(members: DataFrame, k: int) -> DataFrame:
    """(query_id, _last): the places below _last, a multiple of PLACES, hold k that are no members; queries without members have no row.

    Members are counted by runs of places before they are shuffled. One that comes twice counts twice, so _last may be larger than needed.
    """
    runs = members.groupBy("query_id", F.floor(F.col("place") / PLACES).alias("_run")).agg(F.count(F.lit(1)).alias("_m"))
    order = Window.partitionBy("query_id").orderBy("_run")
    upto = F.sum("_m").over(order.rowsBetween(Window.unboundedPreceding, 0))
    up = lambda n: F.ceil(n / PLACES) * PLACES
    # From one run with members to the next nothing is excluded: enough are free either at the run's end or so many places on.
    known = runs.select(
        "query_id", upto.alias("_upto"), ((F.col("_run") + 1) * PLACES).alias("_end"), F.lead("_run").over(order).alias("_next"), F.row_number().over(order).alias("_at"), (F.col("_run") * PLACES).alias("_begin"),
    )
    last = F.greatest("_end", up(F.col("_upto") + k))
    fits = F.when(F.col("_next").isNull() | (last <= F.col("_next") * PLACES), last)
    before = F.when((F.col("_at") == 1) & (up(F.lit(k)) <= F.col("_begin")), up(F.lit(k)))
    return known.groupBy("query_id").agg(F.min(F.least(fits, before)).alias("_last"))


def _others(index: KeywordIndex, only: DataFrame, k: int) -> DataFrame:
    """The first k documents of alternatives that only exclude. Within a scope, the scope's documents are read."""
    same = F.xxhash64(F.array_sort("excluded"), F.array_sort("excluded_phrases"), "_want")
    # Told apart by what they exclude, not by a hash of it alone.
    what = ["_same", "excluded", "excluded_phrases", "_want"]
    named = only.select("query_id", "alternative", F.array_sort("excluded").alias("excluded"), F.array_sort("excluded_phrases").alias("excluded_phrases"), "_want", same.alias("_same"))
    distinct = _saved(named.select(*what).distinct().withColumn("alternative", F.lit(0)).withColumn("query_id", F.monotonically_increasing_id()), "exclusions")
    members = _members(index, distinct)
    asked = distinct.select("query_id", "_want").join(_saved(_first_places(members, k), "last_places"), "query_id", "left")
    total = F.broadcast(index.stats.select(F.col("n").alias("_n"), F.lit(1).alias("_one")))  # one row
    last = F.least(F.col("_n"), F.coalesce("_last", F.lit(k).cast("long")))
    free = asked.filter("_want is null").withColumn("_one", F.lit(1)).join(total, "_one").filter("_n > 0").withColumn("_last", last)
    places = free.select("query_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last") - 1)).alias("place"))
    # A scope's documents may lie anywhere, so all that it excludes is needed.
    needed = free.select("query_id", "_last").unionByName(asked.filter("_want is not null").select("query_id", F.lit(None).cast("long").alias("_last")))
    members = members.join(needed, "query_id").filter("_last is null or place < _last").select("query_id", "place")
    if index.scoped:
        own = index.docs.select("place", F.col("scope").cast("string").alias("_want"))
        places = places.unionByName(asked.filter("_want is not null").join(own, "_want").select("query_id", "place"))
    left = top_k_per_group(places.join(members, ["query_id", "place"], "left_anti"), ["query_id"], ["place"], k)
    found = left.join(index.docs.select("place", *index.keys), "place").join(distinct.drop("alternative"), "query_id").drop("query_id")
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in what]
    both = named.alias("a").join(found.alias("b"), on[0] & on[1] & on[2] & on[3])
    return both.select("a.query_id", "b.place", *[F.col(f"b.{c}") for c in index.keys], F.lit(0.0).alias("score"))


def _first_blocks(candidates: DataFrame, k: int) -> DataFrame:
    """candidates with _first: the blocks of highest bound that together hold k documents of the rarest term, at least one."""
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "alternative", "block")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    return candidates.withColumn("_first", before < k)


def search_rounds(index: KeywordIndex, queries: DataFrame, k: int, query_text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all blocks that hold an alternative's terms, the blocks scored, all documents found with scores)."""
    wanted = _saved(_alternatives(index, queries, query_text), "alternatives")
    by_terms = wanted.filter(F.size("terms") > 0)
    candidates = _saved(_first_blocks(_candidates(index, by_terms), k), "candidate_blocks")
    first = candidates.filter("_first")
    found = _saved(_scored(index, first, by_terms), "first_scores")
    best = found.groupBy("query_id", "place").agg(F.max("score").alias("score"))
    kth = top_k_per_group(best, ["query_id"], [F.desc("score"), "place"], k, "rank").filter(F.col("rank") == k)
    rest = candidates.filter("not _first").join(kth.select("query_id", F.col("score").alias("_kth")), "query_id", "left")
    # Scores are rounded, so a bound just under the k-th score may still reach it.
    second = rest.filter(F.col("_kth").isNull() | (F.col("bound") + 10.0**-DIGITS >= F.col("_kth"))).drop("_kth")
    everything = found.unionByName(_scored(index, second, by_terms))
    only = wanted.filter("size(terms) = 0")
    return candidates, first.unionByName(second), everything.unionByName(_others(index, only, k))


def search_keywords(index: KeywordIndex, queries: DataFrame, k: int, query_text: str = "text") -> DataFrame:
    """The k best documents that satisfy each query, by BM25: query_id, keys, score, rank from 0; ties go to the smaller key."""
    found = search_rounds(index, queries, k, query_text)[2]
    best = found.groupBy("query_id", "place", *index.keys).agg(F.max("score").alias("score")).drop("place")
    ranked = top_k_per_group(best, ["query_id"], [F.desc("score"), *index.keys], k, "rank")
    return ranked.withColumn("rank", F.col("rank") - 1)


def postings_share(candidates: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: postings of the rarest terms that were read, of those in all blocks that hold an alternative's terms."""
    every = candidates.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.lit(1).alias("_one"))
    read = scored.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("read"), F.lit(1).alias("_one"))
    return every.join(read, "_one").select("read", "all", F.try_divide("read", "all").alias("share"))
