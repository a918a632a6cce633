"""Top-k with a total order and 1-based ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top(frame: DataFrame, metric: str, ties: Sequence[str], limit: int) -> DataFrame:
    """The ``limit`` rows with the largest metric; ties go to the smallest tie columns."""
    return frame.orderBy(F.desc(metric), *(F.asc(t) for t in ties)).limit(limit)


def with_rank(best: DataFrame, metric: str, ties: Sequence[str]) -> DataFrame:
    """Number the rows of a result that is already limited to a few rows."""
    order = Window.orderBy(F.desc(metric), *(F.asc(t) for t in ties))
    return best.withColumn("rank", F.row_number().over(order).cast("bigint"))
