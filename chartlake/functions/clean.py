"""Cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))


def map_lookup(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Value for the code, NULL where the code is not in the mapping."""
    return literal_map(mapping)[F.col(col) if isinstance(col, str) else col]


def standardize(col: Column | str) -> Column:
    """Trimmed text with each blank-separated word capitalised."""
    return F.initcap(F.lower(F.trim(col)))


def map_lookup_with_default(col: Column | str, *mappings: Mapping[str, str]) -> Column:
    """Remap through each mapping in turn; a value without an entry is kept.

    Keys are standardized like the labels they are compared with, so a key spelt
    with a capital after a slash still matches.
    """
    out = F.col(col) if isinstance(col, str) else col
    for mapping in mappings:
        normal = {_initcap(k): v for k, v in mapping.items()}
        out = F.coalesce(literal_map(normal)[out], out)
    return out


def _initcap(text: str) -> str:
    return " ".join(w[:1].upper() + w[1:] for w in text.strip().lower().split(" "))


def sentinel_to_null(col: str, sentinel) -> Column:
    return F.nullif(F.col(col), F.lit(sentinel))


def parse_date(col: str, pattern: str = "yyyy-MM-dd") -> Column:
    """Date, or NULL where the text does not parse."""
    return F.try_to_date(F.col(col), pattern)


def is_blank(col: str) -> Column:
    return F.trim(F.col(col)) == ""


def is_missing_token(col: str) -> Column:
    """NULL, blank, and the spelt-out markers NULL and \\N count as missing."""
    c = F.col(col)
    return c.isNull() | F.trim(c).isin("", "NULL", "\\N")
