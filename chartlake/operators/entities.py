"""Entity mentions, fuzzy names and table routing over texts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions.text import NAME_WORD, QUESTION_WORD, contains_any, runs, words
from chartlake.functions.vectors import indel_similarity
from chartlake.session import work_dir


def name_dictionary(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """Entity dictionary: phrase (the name's words), entity (its spelling) and key."""
    return df.filter(F.col(name).isNotNull()).select(
        F.array_join(words(F.col(name), NAME_WORD), " ").alias("phrase"),
        F.col(name).alias("entity"),
        F.col(key or name).alias("key"),
    ).filter("phrase <> ''").distinct()


def alias_dictionary(spark: SparkSession, aliases: Mapping[str, str] = K.COUNTRY_ALIASES) -> DataFrame:
    rows = [(a, name, name) for a, name in aliases.items()]
    return spark.createDataFrame(rows, "phrase STRING, entity STRING, key STRING").withColumn(
        "phrase", F.array_join(words(F.col("phrase"), NAME_WORD), " ")
    )


def phrase_sizes(dictionary: DataFrame) -> DataFrame:
    """One row: the word counts that occur among the phrases."""
    return dictionary.agg(F.sort_array(F.collect_set(F.size(F.split("phrase", " ")))).alias("_sizes"))


def _runs(texts: DataFrame, ids: Sequence[str], text: str, sizes: Column, pattern: str) -> DataFrame:
    """Distinct word runs of each text, one row per run, for each size in the array."""
    return (
        texts.withColumn("_tokens", words(F.col(text), pattern))
        .select(*ids, "_tokens", F.explode(sizes).alias("_n"))
        .select(*ids, F.explode(F.array_distinct(runs("_tokens", "_n"))).alias("gram"))
    )


def text_ngrams(texts: DataFrame, text: str, sizes: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Every distinct 1- to 3-word run of each text, one row per run."""
    ids = [c for c in texts.columns if c != text]
    return _runs(texts, ids, text, F.array(*map(F.lit, sizes)), QUESTION_WORD)


#: Characters of names, counting some for each name, that are sent to every task as an automaton.
DICTIONARY_CHARS = 32 << 20
NAME_OVERHEAD = 64


def _listed(dictionary: DataFrame) -> tuple[DataFrame, bool]:
    """The distinct names, written, as the list is often worked out from facts and is read twice; and whether an automaton may hold them."""
    path = work_dir(dictionary.sparkSession, "names")
    dictionary.select("phrase", "entity", "key").distinct().write.parquet(path)
    listed = dictionary.sparkSession.read.parquet(path)
    size = listed.agg(F.coalesce(F.sum(F.length("phrase") + F.length("entity") + F.length("key") + NAME_OVERHEAD), F.lit(0))).first()[0]
    return listed, size <= DICTIONARY_CHARS


def _automaton(listed: DataFrame):
    """An Aho-Corasick automaton over the phrases between blanks; a phrase's value lists its (entity, key) pairs."""
    import ahocorasick

    pairs: dict[str, list[tuple[str, str]]] = {}
    for phrase, entity, key in listed.collect():
        pairs.setdefault(phrase, []).append((entity, key))
    out = ahocorasick.Automaton()
    for phrase, values in pairs.items():
        out.add_word(f" {phrase} ", values)
    out.make_automaton()
    return out, len(pairs)


def scan_entities(texts: DataFrame, ids: Sequence[str], text: str, dictionary: DataFrame) -> DataFrame:
    """(ids, entity, key, entity_length) of all dictionary names in each text, in one scan without a shuffle.

    The names become an automaton, built once and sent to every task; its size is checked, and larger lists are refused.
    """
    listed, few = _listed(dictionary)
    if not few:
        raise ValueError("the names are too many to send to every task: use by_runs")
    return _scanned(texts, ids, text, listed)


def _scanned(texts: DataFrame, ids: Sequence[str], text: str, dictionary: DataFrame) -> DataFrame:
    automaton, n = _automaton(dictionary)
    shared = texts.sparkSession.sparkContext.broadcast(automaton)
    types = {f.name: f.dataType.simpleString() for f in dictionary.schema}
    spaced = F.concat(F.lit(" "), F.array_join(words(F.col(text), NAME_WORD), " "), F.lit(" "))
    rows = texts.select(*ids, spaced.alias("_spaced"))
    width = len(ids)
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:width]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        for batch in batches:
            at, entities, keys = [], [], []
            for k, body in enumerate(batch.column(width).to_pylist()):
                if body and n:
                    found = {pair for _, pairs in names.iter(body) for pair in pairs}
                    at += [k] * len(found)
                    entities += [e for e, _ in found]
                    keys += [x for _, x in found]
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in range(width)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(entities, pa.string()), pa.array(keys, pa.string())], names=[*ids, "entity", "key"])

    found = rows.mapInArrow(run, ", ".join([*own, f"entity {types['entity']}", f"key {types['key']}"]))
    return found.withColumn("entity_length", F.length("entity"))


def detect_entities(texts: DataFrame, ids: Sequence[str], text: str, dictionary: DataFrame, by_runs: bool | None = False) -> DataFrame:
    """All dictionary names in each text, matched on whole words; the rank is the order of mention lists: longest name first.

    By default texts are scanned with an automaton of the names, which must fit DICTIONARY_CHARS. With by_runs, for lists of any size, a
    text is cut into runs of just the lengths that names have, and the runs meet the names in an equi join, so the work is linear
    in the text. by_runs=None takes runs where the names are too many for an automaton. The ids tell texts apart: rows that share them
    count as one text only with by_runs.
    """
    if by_runs is None:
        dictionary, few = _listed(dictionary)
        if few:
            return _scanned(texts, ids, text, dictionary)
    elif not by_runs:
        return scan_entities(texts, ids, text, dictionary)
    # One row with one array: as many entries as there are distinct name lengths.
    sizes = F.broadcast(phrase_sizes(dictionary).withColumn("_one", F.lit(1)))
    sized = texts.withColumn("_one", F.lit(1)).join(sizes, "_one")
    grams = _runs(sized, ids, text, F.col("_sizes"), NAME_WORD)
    found = grams.withColumnRenamed("gram", "phrase").join(dictionary, "phrase").select(*ids, "entity", "key").distinct()
    return found.withColumn("entity_length", F.length("entity"))


def ordered_mentions(mentions: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per text with its names as an array, longest first."""
    order = F.struct((-F.col("entity_length")).alias("l"), F.col("entity").alias("e"))
    return mentions.groupBy(*ids).agg(F.transform(F.sort_array(F.collect_set(order)), lambda s: s["e"]).alias("entities"))


# --- fuzzy names --------------------------------------------------------------------------
#
# Two texts of m and n characters score 200 * LCS / (m + n). A cutoff bounds the other text's length and the
# common subsequence they need, and each allowed pair of lengths (m, n) gets keys that every match must share:
# where at most two characters may go from either side, the texts with exactly that many removed; otherwise
# the name is cut into one piece more than there may be edits, so that one piece must occur unchanged and
# almost in place in the run. Equal keys are candidates, and the exact score decides.


def _whole(x: Column) -> Column:
    return x.cast("int")


def _ceil(x: Column) -> Column:
    return _whole(F.ceil(x - 1e-9))


def _floor(x: Column) -> Column:
    return _whole(F.floor(x + 1e-9))


def _one_less(s: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1))
    )


def _without(s: Column, k: Column) -> Column:
    """Every text with exactly k (0 to 2) characters removed."""
    two = F.array_distinct(F.flatten(F.transform(_one_less(s), _one_less)))
    return F.when(k == 0, F.array(s)).when(k == 1, F.array_distinct(_one_less(s))).otherwise(two)


def _keys(text: Column, cutoff: float, of_name: bool, shortest: Column | None = None, longest: Column | None = None) -> Column:
    """Keys of one text for every allowed length of the other, within the lengths that occur, if given."""
    c = cutoff / 100
    own = F.length(text)
    low, high = _ceil(own * (c / (2 - c))), _floor(own * ((2 - c) / c))
    if shortest is not None:
        low, high = F.greatest(low, shortest), F.least(high, longest)
    others = F.coalesce(F.when(low <= high, F.sequence(low, high)), F.array().cast("array<int>"))

    def for_length(other: Column) -> Column:
        m, n = (other, own) if of_name else (own, other)
        common = _ceil((m + n) * (c / 2))
        few = F.greatest(m, n) - common <= 2
        removed = F.transform(
            _without(text, own - common), lambda v: F.concat_ws("|", m.cast("string"), n.cast("string"), F.lit("d"), v)
        )

        edits = _floor((m + n) * (1 - c))
        pieces = edits + 1
        size, longer = _whole(F.floor(n / pieces)), n % pieces

        def piece(i: Column) -> Column:
            start = i * size + F.greatest(F.lit(0), i - (pieces - longer))
            length = size + F.when(i >= pieces - longer, 1).otherwise(0)
            first, last = start, start
            if not of_name:
                first = F.greatest(F.lit(0), start - _floor((edits - (m - n)) / 2))
                last = F.least(m - length, start + _floor((edits + (m - n)) / 2))
            spots = F.when(first <= last, F.sequence(first, last))
            return F.transform(
                F.coalesce(spots, F.array().cast("array<int>")),
                lambda p: F.concat_ws(
                    "|", m.cast("string"), n.cast("string"), i.cast("string"), F.substr(text, p + 1, length)
                ),
            )

        kept = F.flatten(F.transform(F.sequence(F.lit(0), edits), piece))
        return F.when(few, removed).otherwise(kept)

    return F.array_distinct(F.flatten(F.transform(others, for_length)))


def similar_names(grams: DataFrame, names: DataFrame, cutoff: float = K.FUZZY_CUTOFF) -> DataFrame:
    """Pairs (gram, entity) that score at least the cutoff; exact, no pair is missed."""
    left = grams.select("gram").distinct().filter("gram <> ''")
    right = names.select("entity", F.lower("entity").alias("folded")).distinct().filter("folded <> ''")
    # One row: a run far longer than any name gets no key at all.
    lengths = right.agg(F.min(F.length("folded")).alias("_min"), F.max(F.length("folded")).alias("_max"), F.lit(1).alias("_one"))
    sized = left.withColumn("_one", F.lit(1)).join(F.broadcast(lengths), "_one")
    gram_keys = _keys(F.col("gram"), cutoff, False, F.col("_min"), F.col("_max"))
    # Keys meet by a hash of eight bytes: equal keys have equal ones, and the exact score decides on chance pairs too. The lists are short
    # against their keys, so they are dealt to all tasks before the keys are made.
    tasks = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = lambda df, keys: df.select("*", F.explode(keys).alias("_key")).withColumn("_key", F.xxhash64("_key"))
    named = hashed(right.repartition(tasks, "folded"), _keys(F.col("folded"), cutoff, of_name=True))
    pairs = (
        hashed(sized.repartition(tasks, "gram"), gram_keys).select("gram", "_key")
        .join(named, "_key")
        # Substitution counts as one edit there and as two here, so this never drops a match.
        .filter(F.levenshtein("gram", "folded") <= (F.length("gram") + F.length("folded")) * (1 - cutoff / 100) + 1e-9)
        .select("gram", "entity", "folded")
        .distinct()
    )
    return pairs.withColumn("score", indel_similarity(F.col("gram"), F.col("folded"))).filter(
        F.col("score") >= cutoff
    ).select("gram", "entity", "score")


def fuzzy_match(
    questions: DataFrame, ids: Sequence[str], text: str, names: DataFrame, cutoff: float = K.FUZZY_CUTOFF
) -> DataFrame:
    """The best-scoring name per question, compared with its 1- to 3-word runs; ties go to the smaller name.

    A run that is a name scores 100, which no other run can exceed, so keys are made only for questions without such a run.
    """
    asked = questions.select(*ids, text)
    folded = names.select(F.lower("entity").alias("gram"), "entity").filter("gram <> ''")
    spelt = text_ngrams(asked, text).join(folded, "gram").groupBy(*ids).agg(F.min("entity").alias("entity"))
    spelt = spelt.select(*ids, "entity", F.lit(100.0).alias("score"))

    same = F.lit(True)
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"_spelt_{c}"))
    grams = text_ngrams(asked.join(spelt.select(*(F.col(c).alias(f"_spelt_{c}") for c in ids)), same, "left_anti"), text)
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("entity").alias("e")))
    close = (
        grams.join(similar_names(grams, names, cutoff), "gram")
        .groupBy(*ids)
        .agg(best.alias("b"))
        .select(*ids, F.col("b.e").alias("entity"), (-F.col("b.s")).alias("score"))
    )
    return spelt.unionByName(close)


# --- routing ------------------------------------------------------------------------------


def keyword_table(lowered: Column, keywords: Mapping[str, Sequence[str]] = K.TABLE_KEYWORDS) -> Column:
    """The first table one of whose keywords occurs."""
    out = F
    for table, terms in keywords.items():
        out = out.when(contains_any(lowered, terms), table)
    return out.otherwise(F.lit(None).cast("string"))


def route_table(
    questions: DataFrame,
    ids: Sequence[str],
    text: str,
    countries: DataFrame,
    artists: DataFrame,
    fuzzy: bool = True,
) -> DataFrame:
    """Source table per question, and whether the evidence is exact.

    Country name or alias, then artist name, then keyword; a fuzzy country or artist only where nothing
    else fits, and never as confident.
    """
    named = {
        "country_performance": detect_entities(questions, ids, text, countries, by_runs=None),
        "artist_performance": detect_entities(questions, ids, text, artists, by_runs=None),
    }
    out = questions.select(*ids, text, keyword_table(F.lower(text)).alias("_keyword"))
    for table, mentions in named.items():
        flags = mentions.select(*ids).distinct().withColumn(f"_{table}", F.lit(table))
        out = out.join(flags, list(ids), "left")
    exact = F.coalesce(*(F.col(f"_{t}") for t in named), "_keyword")
    out = out.select(*ids, text, exact.alias("_exact"))
    if not fuzzy:
        return out.select(*ids, F.col("_exact").alias("source_table"), F.col("_exact").isNotNull().alias("confident"))
    # Fuzzy names are tried only where nothing exact was found.
    open_ = out.filter("_exact is null").select(*ids, text)
    for table, names in (("country_performance", countries), ("artist_performance", artists)):
        close = fuzzy_match(open_, ids, text, names).select(*ids, F.lit(table).alias(f"_fuzzy_{table}"))
        out = out.join(close, list(ids), "left")
    source = F.coalesce("_exact", "_fuzzy_country_performance", "_fuzzy_artist_performance")
    return out.select(*ids, source.alias("source_table"), F.col("_exact").isNotNull().alias("confident"))
