"""Column expressions over whole texts; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the white space that separates words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def whole_text(text: str | Column) -> Column:
    """The text, empty when null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of anything but white space, in order; none for an empty text."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE_RUN)
    )


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo a divisor; -1 for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(divisor)), F.lit(-1))


def constant_longs(values: Iterable[int]) -> Column:
    """A constant array of numbers, sent as one text that Spark folds once per plan."""
    joined = ",".join(map(str, values))
    if not joined:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(joined), ",").cast("array<bigint>")


def constant_doubles(values: Iterable[float]) -> Column:
    """A constant array of doubles, sent as one text that Spark folds once per plan."""
    joined = ",".join(map(repr, values))
    if not joined:
        return F.array().cast("array<double>")
    return F.split(F.lit(joined), ",").cast("array<double>")
