"""Labels and carried context of conversation turns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.functions.text import contains_any, words, years
from chartlake.operators.entities import keyword_table
from chartlake.operators.windows import top_k_per_group


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, "^\\s+|\\s+$", "")


def small_talk(text: Column) -> Column:
    """A greeting or thanks of at most four words, or a question about the assistant itself."""
    folded = F.regexp_replace(F.lower(stripped(text)), "\\s*[!.?]+$", "")
    tokens = F.split(folded, "\\s+")
    thanks = F.lit(False)
    for t in K.THANKS_WORDS:
        thanks = thanks | folded.startswith(t)
    short = (F.size(tokens) <= 4) & (F.get(tokens, F.lit(0)).isin(*K.GREETING_WORDS) | thanks)
    return short | contains_any(folded, K.META_PHRASES)


def follow_up(text: Column) -> Column:
    """Leans on earlier turns: a reference phrase, a pronoun, or a bare comparison."""
    lowered = F.lower(text)
    signals = F.array(*(F.lit(w) for w in dict.fromkeys((*K.FOLLOWUP_WORDS, *K.COMPARISON_WORDS))))
    return contains_any(lowered, K.FOLLOWUP_PHRASES) | F.arrays_overlap(words(text, "[a-z']+"), signals)


def label_turns(turns: DataFrame, text: str = "text") -> DataFrame:
    """Adds small_talk, follow_up, intent, target_table, target_year, previous_year and ascending."""
    lowered = F.lower(F.col(text))
    df = turns.withColumns(
        {
            "small_talk": small_talk(F.col(text)),
            "follow_up": follow_up(F.col(text)),
            "_table": keyword_table(lowered),
            "_years": years(F.col(text)),
            "_count": contains_any(lowered, K.COUNT_KEYWORDS),
            "_trend": contains_any(lowered, K.TREND_KEYWORDS),
            "_super": contains_any(lowered, K.SUPERLATIVE_KEYWORDS),
            "_least": contains_any(lowered, K.ASCENDING_KEYWORDS),
        }
    )
    table, stream = F.col("_table"), lowered.contains("stream")
    intent = (
        F.when(F.col("_count") & stream, "sum")
        .when(table.isNull(), "none")
        .when(F.col("_count") & (table == "kpi_song") & lowered.contains("hit"), "count_hits")
        .when(F.col("_count"), "count")
        .when(F.col("_trend"), F.when(F.size("_years") > 0, "trend").otherwise("none"))
        .when(F.col("_super"), "superlative")
        .otherwise("none")
    )
    first, second = F.get("_years", F.lit(0)), F.get("_years", F.lit(1))
    df = df.withColumn("intent", intent)
    is_trend = F.col("intent") == "trend"
    return df.withColumns(
        {
            # A streams total without a table keyword is a total over all countries.
            "target_table": F.when(F.col("intent") != "none", F.coalesce(table, F.lit("country_performance"))),
            "target_year": F.when(is_trend, F.greatest(first, second)).when(
                F.col("intent").isin("sum", "count_hits"), first
            ),
            "previous_year": F.when(is_trend, F.when(second.isNull(), first - 1).otherwise(F.least(first, second))),
            "ascending": F.col("intent").isin("trend", "superlative") & F.col("_least"),
        }
    ).drop("_table", "_years", "_count", "_trend", "_super", "_least")


def last_n_turns(turns: DataFrame, n: int = 2, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last n turns of each conversation as 'role: text' lines, oldest first."""
    last = top_k_per_group(turns, [conv], [F.desc(turn)], n)
    lines = F.sort_array(F.collect_list(F.struct(turn, F.concat_ws(": ", "role", "text").alias("line"))))
    return last.groupBy(conv).agg(F.array_join(F.transform(lines, lambda s: s["line"]), "\n").alias("history"))


def _state_before(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """For each marker row (entity NULL), the last two distinct entities before it and the last year mark.

    Rows are ordered by _at, markers before pushes, then _push. Neighbouring equal pushes form a run; the last
    run and the run before it are the last two distinct entities.
    """
    order = Window.partitionBy(*group).orderBy("_at", "_push")
    pushes = rows.filter("entity is not null")
    before = F.lag("entity").over(order)
    runs = pushes.withColumn("_changed", F.when(before != F.col("entity"), before))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn(
        "_state", F.struct(F.col("entity").alias("e1"), F.last("_changed", ignorenulls=True).over(so_far).alias("e2"))
    )
    marks = rows.filter("entity is null").withColumn("_state", F.lit(None).cast("struct<e1:string,e2:string>"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    both = marks.unionByName(runs.drop("_changed"))
    return (
        both.withColumn("_before", F.last("_state", ignorenulls=True).over(earlier))
        .withColumn("_year_before", F.last("_year", ignorenulls=True).over(earlier))
        .filter("entity is null")
    )


def carry_forward_entities(
    turns: DataFrame,
    mentions: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    block: int = 10_000,
) -> DataFrame:
    """Per turn: the last two distinct entities mentioned before it, newest first, and the year named by
    the last user turn before it.

    Mentions are rows (conv, turn, entity, entity_length[, kind_rank]); within a turn the smaller kind_rank comes
    first (countries before artists, say), then the longer name. A long conversation is cut into blocks of turns:
    each block is scanned by itself, the blocks' end states are scanned in turn, and a turn's answer is its
    block's state completed by the state before the block. No task sees more than one block of a
    conversation, or one row per block.
    """
    in_block = F.floor(F.col(turn) / block).alias("_block")
    # Only the first two mentions of a turn can matter; the first is pushed last.
    kinds = ["kind_rank"] if "kind_rank" in mentions.columns else []
    first_two = top_k_per_group(
        mentions, [conv, turn], [*kinds, F.desc("entity_length"), "entity"], 2, "_rank"
    ).select(
        conv, in_block, F.col(turn).alias("_at"), (3 - F.col("_rank")).alias("_push"), "entity",
        F.lit(None).cast("struct<y:int>").alias("_year"),
    )
    user_year = F.when(F.col("role") == "user", F.struct(F.get(years(F.col(text)), F.lit(0)).alias("y")))
    marks = turns.select(
        conv, in_block, F.col(turn).alias("_at"), F.lit(0).alias("_push"),
        F.lit(None).cast("string").alias("entity"), user_year.alias("_year"),
    )
    inner = _state_before(marks.unionByName(first_two), [conv, "_block"])

    # The end of each block, as pushes and marks of a shorter sequence.
    latest = first_two.withColumn("_age", F.row_number().over(Window.partitionBy(conv, "_block", "entity").orderBy(F.desc("_at"), F.desc("_push"))))
    ends = top_k_per_group(latest.filter("_age = 1"), [conv, "_block"], [F.desc("_at"), F.desc("_push")], 2, "_rank")
    pushes = ends.select(
        conv, F.col("_block").alias("_at"), (3 - F.col("_rank")).alias("_push"), "entity",
        F.lit(None).cast("struct<y:int>").alias("_year"),
    )
    block_marks = marks.groupBy(conv, F.col("_block").alias("_at")).agg(
        F.max_by("_year", F.when(F.col("_year").isNotNull(), F.col("_at"))).alias("_year")
    ).select(conv, "_at", F.lit(0).alias("_push"), F.lit(None).cast("string").alias("entity"), "_year")
    outer = _state_before(block_marks.unionByName(pushes), [conv]).select(
        conv, F.col("_at").alias("_block"), F.col("_before").alias("_outer"), F.col("_year_before").alias("_outer_year")
    )

    known = F.array_compact(F.array("_before.e1", "_before.e2", "_outer.e1", "_outer.e2"))
    recent = F.array_distinct(known)
    return inner.join(outer, [conv, "_block"], "left").select(
        conv,
        F.col("_at").alias(turn),
        F.get(recent, F.lit(0)).alias("entity_1"),
        F.get(recent, F.lit(1)).alias("entity_2"),
        F.coalesce("_year_before", "_outer_year")["y"].alias("user_year"),
    )
