"""Joining search hits to their details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from snapmart.operators.dedup import keep_first


def hits_with_details(
    hits: DataFrame,
    details: DataFrame,
    key: str,
    order: Sequence[str | Column],
    scope: Sequence[str] = (),
) -> DataFrame:
    """Distinct hits (first to arrive, per scope) with details; others vanish.

    De-duplication comes first, so a hit repeated many times is joined once per
    scope.
    """
    return keep_first(hits, [key], order, scope).join(details, key)
