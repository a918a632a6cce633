"""Row filters shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.texts import contains_any, is_blank, strip
from snapmart.sources.tables import has_key


def drop_without_key(frame: DataFrame, key: str) -> DataFrame:
    """Rows that have an id (not NULL, '' or 0)."""
    return frame.where(has_key(frame, key))


def with_content(frame: DataFrame, text: str, attachments: str) -> DataFrame:
    """Rows with some text or at least one attachment."""
    return frame.where((F.length(text) > 0) | (F.size(attachments) > 0))


def is_excluded(title: Column, excluded: Iterable[str]) -> Column:
    """Whether a channel title contains a listed text; empty titles never do."""
    return F.coalesce(contains_any(strip(F.lower(title)), excluded), F.lit(False))


def exclude_channels(frame: DataFrame, title: str, excluded: Iterable[str]) -> DataFrame:
    """Rows whose channel is not excluded."""
    return frame.where(~is_excluded(F.col(title), excluded))


def drop_blank(frame: DataFrame, column: str) -> DataFrame:
    """Rows whose keyword is more than white space."""
    return frame.where(~is_blank(F.col(column)))


def at_least(frame: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows with ``column >= bound``; NULL never passes."""
    return frame.where(F.col(column) >= F.lit(bound))


def in_category(frame: DataFrame, category: str | None, column: str = "category") -> DataFrame:
    """Rows of one category; None and '' mean no filter."""
    return frame.where(F.col(column) == category) if category else frame
