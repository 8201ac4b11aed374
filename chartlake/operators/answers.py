"""Answers to a whole table of labelled questions in one plan.

Questions are rows (id, intent, target_table, target_year, previous_year, ascending), as label_turns gives them. What does not
name an entity depends on its parameters only, so each distinct set of parameters is answered once and joined back to its
questions; named entities meet the yearly facts in an equi join on table and key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlake.operators.entities import keyword_table
from chartlake.operators.windows import top_k_per_group

#: Intents whose answer is a ranked list; they need two named entities to be narrowed to them, a sum needs one.
RANKED = ("superlative", "trend")
PARAMETERS = ("intent", "source_table", "target_year", "previous_year", "ascending")
ANSWER = ("position", "key", "name", "value")


def yearly_facts(tables: Mapping[str, tuple[DataFrame, str, Column, Column]]) -> DataFrame:
    """(source_table, key, year, name, total, hit) from table -> (monthly rows, key column, name, hit flag).

    One row per entity and year; of several names the smallest.
    """
    out = None
    for table, (df, key, name, hit) in tables.items():
        rows = df.groupBy(F.col(key).alias("key"), "year").agg(
            F.min(name).alias("name"), F.sum("total_streams").cast("long").alias("total"), F.max(hit).cast("int").alias("hit")
        )
        rows = rows.select(F.lit(table).alias("source_table"), "key", "year", "name", "total", "hit")
        out = rows if out is None else out.unionByName(rows)
    return out


def named_targets(labelled: DataFrame, mentions: DataFrame, id: str = "question_id", text: str = "text") -> DataFrame:
    """The labelled questions with target_table set for sums that only an entity places: a country's table, then an artist's.

    Mentions are rows (id, source_table, key).
    """
    has = lambda t: F.max(F.col("source_table") == t)
    seen = mentions.groupBy(id).agg(has("country_performance").alias("_country"), has("artist_performance").alias("_artist"))
    placed = F.when(F.col("_country"), "country_performance").when(F.col("_artist"), "artist_performance")
    free = (F.col("intent") == "sum") & keyword_table(F.lower(F.col(text))).isNull()
    target = F.when(free, F.coalesce(placed, F.col("target_table"))).otherwise(F.col("target_table"))
    return labelled.join(seen, id, "left").withColumn("target_table", target).drop("_country", "_artist")


def _change(total: Column, before: Column) -> Column:
    return total - F.coalesce(before, F.lit(0))


def _ranked(rows: DataFrame, group: list[str], k: int | None) -> DataFrame:
    """Rows of each group by value, largest first unless ascending: the first k, or all."""
    order = [F.asc_nulls_last(F.when(F.col("ascending"), F.col("value")).otherwise(-F.col("value"))), F.asc("key")]
    if k is None:
        return rows.withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return top_k_per_group(rows, group, order, k, "position")


def _general(cases: DataFrame, facts: DataFrame, k: int) -> DataFrame:
    """Answers to distinct sets of parameters without named entities."""
    nothing = F.lit(None).cast("string")

    def single(intent: str, values: DataFrame, by_year: bool) -> DataFrame:
        own = cases.where(F.col("intent") == intent)
        values = values.withColumnRenamed("source_table", "_table")
        on = F.col("source_table") == F.col("_table")
        if by_year:
            on = on & F.col("target_year").eqNullSafe(F.col("_year"))
        return own.join(values, on, "left").select(
            *PARAMETERS, F.lit(1).alias("position"), nothing.alias("key"), nothing.alias("name"), F.coalesce("value", F.lit(0)).cast("long").alias("value")
        )

    yearly = facts.groupBy("source_table", F.col("year").alias("_year")).agg(F.sum("total").alias("value"))
    overall = yearly.groupBy("source_table").agg(F.lit(None).cast("int").alias("_year"), F.sum("value").alias("value"))
    keys = facts.groupBy("source_table", "key").agg(F.min("name").alias("name"), F.sum("total").alias("value"), F.max("hit").alias("hit"))
    count = keys.groupBy("source_table").agg(F.count("key").alias("value"))
    hits = facts.where("hit = 1").groupBy("source_table", F.col("year").alias("_year")).agg(F.count("key").alias("value"))
    all_hits = keys.where("hit = 1").groupBy("source_table").agg(F.lit(None).cast("int").alias("_year"), F.count("key").alias("value"))

    best = _ranked(cases.where("intent = 'superlative'").join(keys.drop("hit"), "source_table"), list(PARAMETERS), k)
    # A trend's entities are those of its target year.
    now = facts.select("source_table", "key", "name", F.col("year").alias("target_year"), "total")
    before = facts.select("source_table", "key", F.col("year").alias("previous_year"), F.col("total").alias("_before"))
    moved = (
        cases.where("intent = 'trend'").join(now, ["source_table", "target_year"])
        .join(before, ["source_table", "key", "previous_year"], "left")
        .withColumn("value", _change(F.col("total"), F.col("_before")))
    )
    trend = _ranked(moved, list(PARAMETERS), k)
    columns = [*PARAMETERS, *ANSWER]
    out = single("sum", yearly.unionByName(overall), True)
    for part in (single("count", count, False), single("count_hits", hits.unionByName(all_hits), True), best, trend):
        out = out.unionByName(part.select(columns))
    return out


def _named(asked: DataFrame, facts: DataFrame, id: str) -> DataFrame:
    """Answers for the entities that a question names: rows of asked hold one key each."""
    rows = asked.join(facts, ["source_table", "key"], "left")
    at = lambda year: F.sum(F.when(F.col("year") == F.col(year), F.col("total")))
    each = rows.groupBy(id, *PARAMETERS, "key").agg(
        F.min("name").alias("name"), F.sum("total").alias("_all"), at("target_year").alias("_now"), at("previous_year").alias("_before")
    )
    sums = each.where("intent = 'sum'").groupBy(id, *PARAMETERS).agg(
        F.coalesce(F.sum(F.when(F.col("target_year").isNull(), F.col("_all")).otherwise(F.col("_now"))), F.lit(0)).cast("long").alias("value")
    )
    nothing = F.lit(None).cast("string")
    sums = sums.select(id, *PARAMETERS, F.lit(1).alias("position"), nothing.alias("key"), nothing.alias("name"), "value")
    value = F.when(F.col("intent") == "trend", _change(F.col("_now"), F.col("_before"))).otherwise(F.col("_all"))
    lists = each.where(F.col("intent").isin(*RANKED)).withColumn("value", value).where("value is not null")
    return sums.unionByName(_ranked(lists, [id], None).select(id, *PARAMETERS, *ANSWER))


def answers(labelled: DataFrame, mentions: DataFrame, facts: DataFrame, id: str = "question_id", k: int = 5) -> DataFrame:
    """(id, intent, source_table, position, key, name, value) for every question with an intent.

    Sums and counts have one row without a key; superlatives and trends have up to k, or all entities named where there are
    two or more. A trend is the change from previous_year to target_year of entities present in the latter.
    """
    asked = labelled.where("intent <> 'none'").select(id, *[F.col("target_table").alias(p) if p == "source_table" else F.col(p) for p in PARAMETERS])
    own = asked.join(mentions.select(id, "source_table", "key").distinct(), [id, "source_table"])
    counts = own.groupBy(id).agg(F.count(F.lit(1)).alias("_n"))
    least = F.when(F.col("intent").isin(*RANKED), 2).when(F.col("intent") == "sum", 1)
    narrowed = counts.join(asked.select(id, "intent"), id).where(F.col("_n") >= least).select(id)
    named = _named(own.join(narrowed, id, "left_semi"), facts, id)

    general = asked.join(narrowed, id, "left_anti")
    found = _general(general.select(*PARAMETERS).distinct(), facts, k)
    # A question's parameters, nulls included, are those of its answer.
    on = F.lit(True)
    for p in PARAMETERS:
        found, on = found.withColumnRenamed(p, f"_{p}"), on & F.col(p).eqNullSafe(F.col(f"_{p}"))
    back = general.join(found, on).select(id, "intent", "source_table", *ANSWER)
    return back.unionByName(named.select(id, "intent", "source_table", *ANSWER))
