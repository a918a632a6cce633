"""Keyed merge of a batch of observations into a master table.

Per column one of three policies applies when a key is already in the master:
``insert_only`` columns keep the master's value (even a NULL), ``overwrite``
columns take the batch's last value, ``add_to_set`` columns gain the batch's
distinct values.

The batch is first reduced to one row per key.  That aggregate runs partially
in every task, so a hot key costs one row per task in the shuffle, and the join
behind it is one row against one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions.texts import is_blank
from snapmart.operators.filters import drop_without_key
from snapmart.operators.sizing import fits_broadcast
from snapmart.sources import buckets
from snapmart.sources.tables import has_key
from snapmart.workspace import new_folder

STATUS = "merge_status"
INSERTED, CHANGED, MATCHED, UNTOUCHED = "inserted", "changed", "matched", "untouched"


@dataclass(frozen=True)
class MergePolicy:
    """What happens to each column of a master on a repeated observation.

    ``add_to_set`` maps an array column of the master to the scalar column of
    the batch whose values it collects.
    """

    key: str
    insert_only: Sequence[str]
    overwrite: Sequence[str]
    add_to_set: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.insert_only, *self.overwrite, *self.add_to_set]


def reduce_batch(batch: DataFrame, policy: MergePolicy, seq: Sequence[str]) -> DataFrame:
    """One row per key: first insert-only values, last overwrite values, set values."""
    order = F.struct(*seq)
    parts = [
        F.min_by(F.struct(*policy.insert_only), order).alias("_first"),
        F.max_by(F.struct(*policy.overwrite), order).alias("_last"),
    ]
    for target, source in policy.add_to_set.items():
        kept = F.when(~is_blank(F.col(source)), F.col(source))
        parts.append(F.collect_set(kept).alias(f"_set_{target}"))
    reduced = drop_without_key(batch, policy.key).groupBy(policy.key).agg(*parts)
    return reduced.select(
        policy.key,
        *(F.col(f"_first.{c}").alias(c) for c in policy.insert_only),
        *(F.col(f"_last.{c}").alias(c) for c in policy.overwrite),
        *(F.array_sort(f"_set_{c}").alias(c) for c in policy.add_to_set),
    )


def merge_reduced(
    master: DataFrame, reduced: DataFrame, policy: MergePolicy, how: str = "full_outer"
) -> DataFrame:
    """Merge a batch that already has one row per key; adds ``merge_status``.

    With ``how="left"`` keys that are only in the batch are left out.
    """
    key = policy.key
    values = policy.columns[1:]
    old = master.select(key, *(F.col(c).alias(f"_old_{c}") for c in values), F.lit(1).alias("_o"))
    new = reduced.select(key, *(F.col(c).alias(f"_new_{c}") for c in values), F.lit(1).alias("_n"))
    in_old, in_new = F.col("_o").isNotNull(), F.col("_n").isNotNull()

    result: dict[str, Column] = {}
    for c in policy.insert_only:
        result[c] = F.when(in_old, F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}"))
    for c in policy.overwrite:
        result[c] = F.when(in_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}"))
    differs = F.lit(False)
    for c in policy.overwrite:
        differs = differs | ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    for c in policy.add_to_set:
        was, gain = F.col(f"_old_{c}"), F.col(f"_new_{c}")
        result[c] = (
            F.when(~in_new, was)
            .when(was.isNull(), gain)
            .otherwise(F.array_sort(F.array_union(was, gain)))
        )
        differs = differs | (F.size(F.array_except(gain, F.coalesce(was, F.array()))) > 0)
    status = (
        F.when(~in_old, INSERTED).when(~in_new, UNTOUCHED).when(differs, CHANGED).otherwise(MATCHED)
    )
    return old.join(new, key, how).select(
        key, *(result[c].alias(c) for c in values), status.alias(STATUS)
    )


def merge_master(
    master: DataFrame, batch: DataFrame, policy: MergePolicy, seq: Sequence[str]
) -> DataFrame:
    """The new master, with ``merge_status``, after one batch of observations."""
    return merge_reduced(master, reduce_batch(batch, policy, seq), policy)


def merge_small_batch(
    master: DataFrame,
    batch: DataFrame,
    policy: MergePolicy,
    seq: Sequence[str],
    limit: int = settings.BROADCAST_BYTES,
) -> DataFrame:
    """The same result without shuffling the master, when the reduced batch is small.

    The batch is reduced once, into a written table.  If that measures small
    enough to broadcast, the master is read once and meets it where it lies; the
    batch's new keys are those that a second look at the master's keys does not
    find.  Larger batches take the general way with the same reduced table.
    """
    folder = new_folder(batch.sparkSession, "reduced-batch")
    shape = reduce_batch(batch, policy, seq)
    shape.write.parquet(folder)
    reduced = batch.sparkSession.read.schema(shape.schema).parquet(folder)
    if not fits_broadcast(reduced, limit):
        return merge_reduced(master, reduced, policy)
    key = policy.key
    met = merge_reduced(master, F.broadcast(reduced), policy, "left")
    # At most as many keys as the reduced batch has rows.
    known = master.select(key).join(F.broadcast(reduced.select(key)), key, "left_semi")
    fresh = reduced.join(known.distinct(), key, "left_anti")
    return met.unionByName(fresh.select(*policy.columns, F.lit(INSERTED).alias(STATUS)))


def merge_buckets(
    batch: DataFrame,
    policy: MergePolicy,
    seq: Sequence[str],
    root: str,
    version: int,
    n_buckets: int = buckets.BUCKETS,
) -> buckets.Manifest:
    """Merge a batch into a master in buckets, as a new version; others stay as they are.

    The batch is reduced into a written table, and only buckets that hold one of
    its keys are read and written.  A batch without keys makes a version that
    shares all files.
    """
    spark, key = batch.sparkSession, policy.key
    base = buckets.latest_manifest(spark, root, version - 1) or buckets.Manifest(-1, n_buckets)
    shape = reduce_batch(batch, policy, seq)
    folder = new_folder(spark, "reduced-batch")
    shape.write.parquet(folder)
    reduced = spark.read.schema(shape.schema).parquet(folder)
    hit = buckets.buckets_hit(reduced, [key], base.buckets)
    old = buckets.read_parts(spark, root, base.of(hit), shape.schema)
    merged = merge_reduced(old, reduced, policy).drop(STATUS)
    return buckets.replace_buckets(merged, root, [key], base, hit, version)


def read_buckets(
    spark: SparkSession, policy: MergePolicy, like: DataFrame, root: str, at_most: int | None = None
) -> DataFrame:
    """The newest version of a master in buckets; ``like`` is any batch of it."""
    schema = reduce_batch(like, policy, [policy.key]).schema
    found = buckets.latest_manifest(spark, root, at_most)
    return buckets.read_parts(spark, root, found.parts if found else (), schema)


def merge_counters(
    merged: DataFrame, batch: DataFrame, policy: MergePolicy, bad: DataFrame | None = None
) -> DataFrame:
    """One row: inserted, updated (values changed), matched (key found), history_inserted, errors.

    Errors are the batch's rows without a key and the rows of ``bad``, the
    records that could not be read.
    """
    keyed = F.coalesce(has_key(batch, policy.key), F.lit(False))
    marks = merged.select(STATUS).unionByName(
        batch.select(F.when(keyed, "history").otherwise("error").alias(STATUS))
    )
    if bad is not None:
        marks = marks.unionByName(bad.select(F.lit("error").alias(STATUS)))

    def times(*wanted: str) -> Column:
        return F.count_if(F.col(STATUS).isin(*wanted))

    return marks.agg(
        times(INSERTED).alias("inserted"),
        times(CHANGED).alias("updated"),
        times(CHANGED, MATCHED).alias("matched"),
        times("history").alias("history_inserted"),
        times("error").alias("errors"),
    )
