"""Counts, prices and roundings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.settings import PRICE_SCALE

_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(E[+-]?[0-9]+)?$"


def tidy_count(shown: Column) -> Column:
    """Upper case, without commas and outer blanks."""
    return F.trim(F.replace(F.upper(shown), F.lit(","), F.lit("")))


def count_of_tidy(tidy: Column) -> Column:
    """:func:`parse_count` for text that went through :func:`tidy_count`."""

    def scaled(letter: str, factor: int) -> Column:
        digits = F.trim(F.replace(tidy, F.lit(letter), F.lit("")))
        return F.when(
            digits.rlike(_PLAIN_NUMBER), (digits.try_cast("double") * factor).try_cast("bigint")
        )

    return (
        F.when(tidy.isNull(), F.lit(0).cast("bigint"))
        .when(F.contains(tidy, F.lit("K")), scaled("K", 1_000))
        .when(F.contains(tidy, F.lit("M")), scaled("M", 1_000_000))
        .otherwise(whole(tidy))
    )


def parse_count(shown: Column) -> Column:
    """Counts as people write them: '2.9K', '1.5M', '1,234', '298'.

    Unreadable plain text is 0.  Text with a K or M around something that is
    no number gives NULL: callers reject that record.
    """
    return count_of_tidy(tidy_count(shown))


def whole(value: Column) -> Column:
    """Text or number to BIGINT, 0 when it is missing or unreadable."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def from_price_units(units: Column) -> Column:
    """Integer price units to currency."""
    return units.try_cast("double") / F.lit(float(PRICE_SCALE))


def discount_text(before: Column, after: Column) -> Column:
    """Discount in whole percent, ties to even; '0%' without a positive price."""
    percent = F.bround((before - after) / before * 100, 0).try_cast("bigint")
    return F.when(before > 0, F.concat(percent.cast("string"), F.lit("%"))).otherwise("0%")


def two_places(value: Column) -> Column:
    """Round to two places, ties to even."""
    return F.bround(value, 2)


def with_separators(value: Column) -> Column:
    """1234567 as '1,234,567'."""
    return F.format_number(value, 0)


def added(*values: Column) -> Column:
    """Sum that is NULL as soon as one part is."""
    return reduce(lambda left, right: left + right, values)
