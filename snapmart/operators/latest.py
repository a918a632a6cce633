"""Newest snapshot per entity and its attachment to entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.operators.dedup import first_rows
from snapmart.operators.sizing import fits_broadcast

LATEST = "latest_metrics"


def latest_per_key(
    snapshots: DataFrame, key: str, time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key; ties in time go to the largest tie columns."""
    return first_rows(snapshots, [key], [F.desc(time), *(F.desc(t) for t in ties)], 1)


def attach_latest(
    entities: DataFrame,
    snapshots: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str] = (),
    into: str = LATEST,
) -> DataFrame:
    """Entities with their newest snapshot as a struct; entities without one vanish.

    The snapshot side has one row per key when it is joined, so a key with very
    many snapshots does not skew the join.
    """
    newest = latest_per_key(snapshots, key, time, ties)
    values = [c for c in newest.columns if c != key]
    return entities.join(newest.select(key, F.struct(*values).alias(into)), key)


def attach_latest_selective(
    entities: DataFrame,
    snapshots: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str] = (),
    into: str = LATEST,
    limit: int = settings.BROADCAST_BYTES,
) -> DataFrame:
    """As :func:`attach_latest`, for a filtered, usually small set of entities.

    When the entity keys are measured to be small they are broadcast, and only
    the snapshots of those entities are ranked; otherwise all are.
    """
    keys = entities.select(key)
    if fits_broadcast(keys, limit):
        snapshots = snapshots.join(F.broadcast(keys), key, "left_semi")
    return attach_latest(entities, snapshots, key, time, ties, into)


def attach_global_latest(
    entities: DataFrame,
    snapshots: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str] = (),
    into: str = LATEST,
) -> DataFrame:
    """Every entity with the one globally newest snapshot (an uncorrelated lookup).

    The newest row is a scalar sub-query: one partial maximum per task, no join.
    Without any snapshot the result is empty.
    """
    values = [c for c in snapshots.columns if c != key]
    newest = snapshots.agg(
        F.max_by(F.struct(*values), F.struct(time, *ties, key)).alias("newest")
    ).scalar()
    return entities.withColumn(into, newest).where(F.col(into).isNotNull())
