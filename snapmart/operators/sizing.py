"""Measured sizes that decide whether a side may be broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart import settings

# Row overhead of a hashed relation, generously.
_ROW_OVERHEAD = 64


def measured_bytes(frame: DataFrame) -> int:
    """Upper estimate of the in-memory size of a narrow frame (one aggregate row)."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in frame.columns]
    row = reduce(lambda left, right: left + right, widths, F.lit(_ROW_OVERHEAD)).cast("bigint")
    return frame.agg(F.coalesce(F.sum(row), F.lit(0)).alias("n")).first()["n"]


def fits_broadcast(frame: DataFrame, limit: int = settings.BROADCAST_BYTES) -> bool:
    """Whether a narrow frame was measured to be small enough to broadcast."""
    return measured_bytes(frame) <= limit
