"""Keep-first de-duplication, caps per group, and tests against known ids.

All of these order by an explicit arrival column.  Ranked windows with a small
bound are trimmed before the shuffle (``WindowGroupLimit``), so a hot id or a
hot keyword sends at most a few rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart import settings


def first_rows(
    frame: DataFrame, groups: Sequence[str], order: Sequence[str | Column], count: int
) -> DataFrame:
    """The first ``count`` rows of each group in the given (total) order.

    A group is first cut inside sub-groups salted by the order columns, then as
    a whole; a row among the first of its group is among the first of its
    sub-group.  Both cuts are trimmed in the tasks before they shuffle, so of a
    hot group the last task gets ``SALT_BUCKETS * count`` rows at most.  Spark
    trims up to the session's limit (see ``session.SETTINGS``); beyond it the
    result is the same, and sub-groups are cut after their shuffle.
    """
    place = "_place"
    ordering = [F.col(o) if isinstance(o, str) else o for o in order]

    def cut(rows: DataFrame, keys: list[str]) -> DataFrame:
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
        return rows.withColumn(place, ranked).where(F.col(place) <= count).drop(place)

    if count > 1:
        named = [o for o in order if isinstance(o, str)] or list(groups)
        salt = F.pmod(F.xxhash64(*named), F.lit(settings.SALT_BUCKETS))
        frame = cut(frame.withColumn("_salt", salt), [*groups, "_salt"]).drop("_salt")
    return cut(frame, list(groups))


def keep_first(
    frame: DataFrame,
    ids: Sequence[str],
    order: Sequence[str | Column],
    scope: Sequence[str] = (),
) -> DataFrame:
    """One row per id (and scope): the first to arrive."""
    return first_rows(frame, [*scope, *ids], order, 1)


def cap_per_group(
    frame: DataFrame, groups: Sequence[str], order: Sequence[str | Column], count: int
) -> DataFrame:
    """At most ``count`` rows per keyword or category, the first to arrive."""
    return first_rows(frame, groups, order, count)


def not_seen(batch: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key is not among the known ones.

    The known keys are made distinct first (partially in every task), and a hot
    key of the batch is split by AQE, as an anti join may split its left side.
    """
    return batch.join(known.select(key).distinct(), key, "left_anti")


def split_known(batch: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Each distinct key of a batch with ``is_known``: already in ``known`` or new."""
    keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    marks = known.select(key).distinct().withColumn("_known", F.lit(True))
    return keys.join(marks, key, "left").select(
        key, F.coalesce("_known", F.lit(False)).alias("is_known")
    )
