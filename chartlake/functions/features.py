"""Row-level chart features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlake import constants as K


def bands_up_to(col: Column, bands, default: str | None) -> Column:
    """First label whose upper bound is not exceeded."""
    out = F
    for bound, label in bands:
        out = out.when(col <= bound, label)
    return out.otherwise(default) if default is not None else out


def hit_category(rank: str = "rank") -> Column:
    return bands_up_to(F.col(rank), K.HIT_BANDS, K.HIT_DEFAULT)


def is_hit(category: str = "hit_category") -> Column:
    return F.col(category).isin(*K.HIT_CATEGORIES)


def chart_strength_raw() -> Column:
    return F.round(
        (201 - F.col("rank")) * 0.4
        + (201 - F.col("peak_rank")) * 0.3
        + F.col("days_on_chart") * 0.2
        + F.col("consecutive_days") * 0.1,
        2,
    )


def chart_strength_normalized(max_days: Column, max_consecutive: Column) -> Column:
    return F.round(
        (201 - F.col("rank")) / 200 * 40
        + (201 - F.col("peak_rank")) / 200 * 30
        + F.try_divide(F.col("days_on_chart"), max_days) * 20
        + F.try_divide(F.col("consecutive_days"), max_consecutive) * 10,
        2,
    )


def valid_release_date() -> Column:
    """The release date, unless it lies after the chart date."""
    return F.when(F.col("release_date") <= F.col("date"), F.col("release_date"))


def song_age_days() -> Column:
    return F.datediff("date", "valid_release_date")


def song_age_category(age: str = "song_age_days") -> Column:
    c = F.col(age)
    return bands_up_to(c, K.AGE_BANDS, None).when(c > K.AGE_BANDS[-1][0], K.AGE_OLDEST).otherwise(K.AGE_MISSING)


def rank_movement() -> Column:
    """Places gained; NULL for a new entry (previous rank not positive)."""
    return F.when(F.col("previous_rank") > 0, F.col("previous_rank") - F.col("rank"))


_COMPARE = {
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "=": lambda c, v: c == v,
    "<=": lambda c, v: c <= v,
}


def movement_category(rules, default: str, movement: str = "rank_movement") -> Column:
    c = F.col(movement)
    out = F.when(c.isNull(), K.MOVEMENT_MISSING)
    for op, bound, label in rules:
        out = out.when(_COMPARE[op](c, bound), label)
    return out.otherwise(default)


def movement_category_v1() -> Column:
    return movement_category(K.MOVEMENT_V1, K.MOVEMENT_V1_DEFAULT)


def movement_category_v2() -> Column:
    return movement_category(K.MOVEMENT_V2, K.MOVEMENT_V2_DEFAULT)


def stream_tier(tiers=K.STREAM_TIERS_V2, streams: str = "streams") -> Column:
    out = F
    for bound, label in tiers:
        out = out.when(F.col(streams) >= bound, label)
    return out.otherwise(K.STREAM_DEFAULT)


def year_month_label(year: str = "year", month: str = "month") -> Column:
    """'Jan 2024'."""
    return F.date_format(F.make_date(F.col(year), F.col(month), F.lit(1)), "MMM yyyy")


def year_month_key(year: str = "year", month: str = "month") -> Column:
    """'2024-01'."""
    return F.format_string("%04d-%02d", F.col(year), F.col(month))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, NULL where the whole is 0 or NULL."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def percent_or_zero(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0)), digits)
