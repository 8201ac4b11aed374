"""Question tables derived from the cleaned chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind -> text; {name}, {typo} (the name without its y) and {year} are filled in for every country and year.
COUNTRY_TEMPLATES = {
    "lookup": "How did {name} perform in {year}?",
    "sum": "How many total streams does {name} have in {year}?",
    "growth": "Which country grew the most in {year}?",
    "growth_between": "Which artists grew fastest between {year} and 2001, in {name}",
    "superlative": "Which label had the lowest numbers in {name}",
    "compare": "which grew faster, {name} or Country 1?",
    "hits": "How many hit songs were there in {year} in {name}",
    "count": "number of tracks in {name}",
    "thanks": "Thanks {name}!",
    "open": "Tell me about streaming in {name} in {year}",
    "misspelt": "How is {typo} doing",
    "off_topic": "What is the weather like in {year}?",
}
ARTIST_TEMPLATES = {
    "artist": "How did {name} do in {year}?",
    "artist_more": "what about {name}",
}


def _filled(template: str) -> Column:
    out = F.lit(template)
    typo = F.replace(F.col("name"), F.lit("y"), F.lit(""))
    for mark, value in (("{name}", F.col("name")), ("{typo}", typo), ("{year}", F.col("year").cast("string"))):
        out = F.replace(out, F.lit(mark), value)
    return out


def _ask(pairs: DataFrame, templates: dict[str, str]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), _filled(t).alias("text")) for k, t in templates.items()))
    return pairs.select("name", "year", F.inline(rows)).select(
        F.concat_ws("|", "kind", "name", F.col("year").cast("string")).alias("question_id"), "text"
    )


def country_questions(silver: DataFrame) -> DataFrame:
    """Every template for every country and year."""
    return _ask(silver.select(F.col("country_name").alias("name"), "year").distinct(), COUNTRY_TEMPLATES)


def artist_questions(artist_performance: DataFrame) -> DataFrame:
    """Every template for every artist name and year."""
    return _ask(artist_performance.select(F.col("artist_name").alias("name"), "year").distinct(), ARTIST_TEMPLATES)
