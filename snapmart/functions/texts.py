"""Text cleaning, containment tests and small string helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that also count.
_SPACE = r"[\s\x1c-\x1f]"


def clean_spaces(text: Column) -> Column:
    """Each run of white space becomes one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, f"(?U){_SPACE}+", " "))


def strip(text: Column) -> Column:
    """Remove white space (of any kind) at both ends."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def contains_any(lowered: Column, terms: Iterable[str]) -> Column:
    """Whether text that is already lower case contains one of the terms."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(lowered, F.lit(term))
    return hit


def first_chars(text: Column, count: int) -> Column:
    """The first ``count`` code points."""
    return F.substring(text, 1, count)


def split_list(text: Column, mark: str = ",") -> Column:
    """Split, strip each part and drop empty parts (delimiter taken literally)."""
    parts = F.transform(F.split(text, f"\\Q{mark}\\E"), strip)
    return F.filter(parts, lambda part: part != "")


def category_of(
    fields: Sequence[Column], categories: Iterable[tuple[str, Sequence[str]]], default: str
) -> Column:
    """First category, in the given order, with a term inside any field.

    ``fields`` must be lower case already; keep them in columns of their own so
    that the lower-casing is done once per row and not once per term.
    """
    chosen = None
    for name, terms in categories:
        hit = F.lit(False)
        for field in fields:
            hit = hit | contains_any(F.coalesce(field, F.lit("")), terms)
        chosen = F.when(hit, name) if chosen is None else chosen.when(hit, name)
    return F.lit(default) if chosen is None else chosen.otherwise(default)


def surrogate_number(name: Column, modulus: int) -> Column:
    """A stable number for a name: the first 60 bits of its MD5, modulo."""
    digits = F.substring(F.md5(name), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(modulus))
