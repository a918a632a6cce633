"""Incremental versions of the batch jobs.

All state that has to outlive a query is a written table below shared folders:
the history (one folder per micro-batch, replaced when the batch is replayed)
is the truth, a master version is a fold of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart.operators.dedup import keep_first
from snapmart.operators.merge import (
    STATUS,
    MergePolicy,
    merge_buckets,
    merge_small_batch,
    reduce_batch,
)
from snapmart.operators.sizing import fits_broadcast
from snapmart.sources import buckets, tables

BATCH = "batch_id"


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over Parquet files that land at a path (folder, file pattern)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drop_repeats(stream: DataFrame, ids: Sequence[str], time: str, delay: str) -> DataFrame:
    """Repeats of an id within the watermark delay are dropped.

    Which of several rows is kept is not defined, so this is for streams whose
    rows of one id are equal; :func:`start_first_seen` keeps the first by order.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(ids))


def run_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process what has landed so far in micro-batches, then stop."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_available(stream: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    """Append what has landed so far to a Parquet folder, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def _batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    # The folder's batch_id is a partition column: bounds on it prune folders.
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    found = tables.read_if_any(spark, root, full)
    return spark.createDataFrame([], full) if found is None else found


def start_first_seen(
    stream: DataFrame,
    ids: Sequence[str],
    order: Sequence[str],
    root: str,
    checkpoint: str,
    n_buckets: int = buckets.BUCKETS,
) -> StreamingQuery:
    """Write each id's first row, by order within a batch and by batch across them.

    No watermark, no id is ever forgotten.  A micro-batch is cut to one row per
    id, and meets the known ids of the buckets that it hits only; these have a
    bounded number of files however many batches there were.  If the batch's
    ids are measured to be few, only they are looked up there.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        accept_first(batch, batch_id, ids, order, root, n_buckets)

    return run_available(stream, checkpoint, handle)


def accept_first(
    batch: DataFrame,
    batch_id: int,
    ids: Sequence[str],
    order: Sequence[str],
    root: str,
    n_buckets: int = buckets.BUCKETS,
) -> DataFrame:
    """The first row of each id that no earlier batch had, written and known from now on."""
    spark, keys, known_root = batch.sparkSession, list(ids), f"{root}/_known"
    # Not the version of this very batch: a replay looks at what was known before.
    base = buckets.latest_manifest(spark, known_root, batch_id - 1)
    base = base or buckets.Manifest(-1, n_buckets)
    # Used several times below; a lost part of it is computed again.
    first = keep_first(batch, keys, order).persist()
    try:
        wanted = first.select(*keys)
        hit = base.of(buckets.buckets_hit(wanted, keys, base.buckets)) if base.parts else []
        seen = buckets.read_parts(spark, known_root, hit, wanted.schema)
        if hit and fits_broadcast(wanted):
            seen = _among(seen, F.broadcast(wanted), keys, "left_semi")
        fresh = _among(first, seen, keys, "left_anti").select(*batch.columns)
        tables.write_history_batch(fresh, root, batch_id)
        # What was written, not what would be computed, is what is known from now on.
        accepted = spark.read.schema(batch.schema).parquet(f"{root}/{BATCH}={batch_id}")
        buckets.add_rows(accepted.select(*keys), known_root, keys, base, batch_id)
    finally:
        first.unpersist()
    return accepted


def _among(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join in which nulls equal each other, as they do for keep-first."""
    right = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(right, same, how)


def read_first_seen(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows accepted so far."""
    return _batches(spark, root, schema).drop(BATCH)


def fold_master(
    spark: SparkSession,
    policy: MergePolicy,
    seq: Sequence[str],
    schema: T.StructType,
    history: str,
    master: str,
    upto: int,
    base: int | None,
) -> DataFrame:
    """The master after batch ``upto``: version ``base`` plus the history after it."""
    later = _batches(spark, history, schema).where(F.col(BATCH) <= upto)
    # An earlier batch comes first whatever its seq, however many are folded at once.
    seq = [BATCH, *seq]
    if base is None:
        return reduce_batch(later, policy, seq)
    later = later.where(F.col(BATCH) > base)
    old = tables.read_version(spark, master, base)
    return merge_small_batch(old, later, policy, seq).drop(STATUS)


def current_master(
    spark: SparkSession,
    policy: MergePolicy,
    seq: Sequence[str],
    schema: T.StructType,
    history: str,
    master: str,
    upto: int,
) -> DataFrame:
    """The master after batch ``upto``, wherever the last written version stands."""
    base = tables.latest_version(spark, master, upto)
    if base == upto:
        return tables.read_version(spark, master, base)
    return fold_master(spark, policy, seq, schema, history, master, upto, base)


def start_merge(
    stream: DataFrame,
    policy: MergePolicy,
    seq: Sequence[str],
    history: str,
    master: str,
    checkpoint: str,
    fold_every: int = 1,
    moment: str | None = None,
) -> StreamingQuery:
    """Append each micro-batch to the history and fold it into the master.

    A large master need not be rewritten for every small batch: with
    ``fold_every`` = n a version is written after every n-th batch, and
    :func:`current_master` adds the batches since on reading.  Replaying a batch
    rewrites its own folder and version only.  With ``moment`` a batch's history
    is also partitioned by day, for :func:`tables.read_history`.
    """
    schema = stream.schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables.write_history_batch(batch, history, batch_id, moment)
        if (batch_id + 1) % fold_every == 0:
            # Not the version of this very batch: a replay folds it anew.
            base = tables.latest_version(spark, master, batch_id - 1)
            folded = fold_master(spark, policy, seq, schema, history, master, batch_id, base)
            tables.write_version(folded, master, batch_id)

    return run_available(stream, checkpoint, handle)


def start_bucketed_merge(
    stream: DataFrame,
    policy: MergePolicy,
    seq: Sequence[str],
    history: str,
    master: str,
    checkpoint: str,
    n_buckets: int = buckets.BUCKETS,
    moment: str | None = None,
) -> StreamingQuery:
    """:func:`start_merge` over a master in buckets: a batch rewrites those it has keys of.

    A replayed batch is merged into the version before it once more.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables.write_history_batch(batch, history, batch_id, moment)
        merge_buckets(batch, policy, seq, master, batch_id, n_buckets)

    return run_available(stream, checkpoint, handle)
