"""Text expressions: words, n-grams, stems, phrase tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUESTION_WORD = "[a-z0-9']+"
INDEX_WORD = "[\\p{L}\\p{N}]+"
NAME_WORD = INDEX_WORD  # an apostrophe ends a word, so a possessive or quoted name is found


def words(text: Column, pattern: str = QUESTION_WORD) -> Column:
    """All words of the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def runs(tokens: str, n: str) -> Column:
    """Every run of n neighbouring words, blank-joined, in order.

    Takes the names of columns that already hold the word array and the size: an expression would be worked
    out again for every word. Words are fetched by position, since a slice copies the array.
    """
    words_at = lambda i: F.transform(
        F.sequence(i, i + F.col(n) - 1), lambda j: F.get(F.col(tokens), j)
    )
    starts = F.when(F.size(tokens) >= F.col(n), F.sequence(F.lit(0), F.size(tokens) - F.col(n)))
    return F.coalesce(
        F.transform(starts, lambda i: F.array_join(words_at(i), " ")), F.array().cast("array<string>")
    )


def stem(word: Column) -> Column:
    """Plural stemmer: -ies to -y, -es to -e, -s dropped, with the usual exceptions."""
    return (
        F.when(~word.endswith("s"), word)
        .when(word.rlike("[^ea]ies$"), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("[^aeo]es$"), F.regexp_replace(word, "es$", "e"))
        .when(word.rlike("[^us]s$"), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """Whether the text holds one of the phrases, anywhere."""
    out = F.lit(False)
    for phrase in phrases:
        out = out | text.contains(phrase)
    return out


def years(text: Column) -> Column:
    """All years 20xx, in order of mention."""
    return F.transform(F.regexp_extract_all(text, F.lit("\\b(20\\d{2})\\b"), F.lit(1)), lambda y: y.cast("int"))
