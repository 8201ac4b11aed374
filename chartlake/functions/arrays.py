"""Pipe-delimited attributes as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIPE = "\\|"


def parts(col: str) -> Column:
    """Trimmed, non-empty parts; an empty array for NULL."""
    trimmed = F.transform(F.split(F.col(col), PIPE), lambda x: F.trim(x))
    return F.coalesce(F.filter(trimmed, lambda x: x != ""), F.array().cast("array<string>"))


def credits(uris: str = "artist_uris", names: str = "artist_names") -> Column:
    """Lock-step (artist_uri, artist_name) pairs; the shorter side is padded with NULL."""
    return F.transform(
        F.arrays_zip(F.split(F.col(uris), PIPE).alias("u"), F.split(F.col(names), PIPE).alias("n")),
        lambda z: F.struct(F.trim(z["u"]).alias("artist_uri"), F.trim(z["n"]).alias("artist_name")),
    )


def named_credits(uris: str = "artist_uris", names: str = "artist_names", unknown: str = "Unknown Artist") -> Column:
    """Credits with both a uri and a real name."""
    return F.filter(
        credits(uris, names),
        lambda c: c["artist_uri"].isNotNull()
        & (c["artist_uri"] != "")
        & c["artist_name"].isNotNull()
        & (c["artist_name"] != "")
        & (c["artist_name"] != unknown),
    )


def credits_tolerant(uris: str = "artist_uris", names: str = "artist_names") -> Column:
    """Credits where a name may hold a literal pipe.

    If the two sides differ in length, the whole name text is repeated for every uri.
    """
    u, n = F.split(F.col(uris), PIPE), F.split(F.col(names), PIPE)
    fitted = F.when(F.size(n) == F.size(u), n).otherwise(F.array_repeat(F.col(names), F.size(u)))
    return F.transform(
        F.arrays_zip(u.alias("u"), fitted.alias("n")),
        lambda z: F.struct(z["u"].alias("artist_uri"), z["n"].alias("artist_name")),
    )
