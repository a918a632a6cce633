"""Caps and totals kept up to date by micro-batches.

What is known of a group lies in hash buckets (:mod:`snapmart.sources.buckets`),
one version for every micro-batch.  A batch adds rows for the groups that it
has; the rows of a group are added up on reading, and whenever the folders of
its bucket are brought into one.  Version n starts from the newest version before
n, so a batch that is replayed takes back what it had added before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart.operators.dedup import cap_per_group
from snapmart.sources import buckets, tables
from snapmart.streaming.jobs import BATCH, accept_first, run_available

TAKEN = "_taken"


def _base(spark: SparkSession, state: str, batch_id: int, n_buckets: int) -> buckets.Manifest:
    """What was known before a batch."""
    return buckets.latest_manifest(spark, state, batch_id - 1) or buckets.Manifest(-1, n_buckets)


def _with_taken(rows: DataFrame, taken: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with ``TAKEN`` of their group, 0 for a new one; a null group is one like any other."""
    known = taken.select(*(F.col(k).alias(f"_r_{k}") for k in keys), TAKEN)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return rows.join(known, same, "left").select(
        *rows.columns, F.coalesce(TAKEN, F.lit(0)).alias(TAKEN)
    )


def accept_capped(
    batch: DataFrame,
    batch_id: int,
    groups: Sequence[str],
    order: Sequence[str],
    count: int,
    root: str,
    n_buckets: int = buckets.BUCKETS,
) -> DataFrame:
    """The batch's rows for which their group still has room, written and counted.

    A batch is first cut to ``count`` rows a group, in its tasks, so a hot group
    is small before it meets what is known of it.
    """
    spark, keys, state = batch.sparkSession, list(groups), f"{root}/{TAKEN}"
    base = _base(spark, state, batch_id, n_buckets)
    first = cap_per_group(batch, keys, order, count).persist()
    try:
        hit = base.of(buckets.buckets_hit(first, keys, base.buckets)) if base.parts else []
        like = T.StructType([*first.select(*keys).schema, T.StructField(TAKEN, T.LongType())])

        def added_up(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*keys).agg(F.sum(TAKEN).alias(TAKEN))

        taken = added_up(buckets.read_parts(spark, state, hit, like))
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        room = _with_taken(first, taken, keys).where(F.col(TAKEN) < count)
        accepted = room.withColumn("_place", place).where(F.col("_place") + F.col(TAKEN) <= count)
        tables.write_history_batch(accepted.select(*batch.columns), root, batch_id)
        # What was written, not what would be computed, counts from now on.
        written = spark.read.schema(batch.schema).parquet(f"{root}/{BATCH}={batch_id}")
        part = written.groupBy(*keys).agg(F.count(F.lit(1)).alias(TAKEN))
        buckets.add_rows(part, state, keys, base, batch_id, added_up)
    finally:
        first.unpersist()
    return written


def start_capped(
    stream: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    count: int,
    root: str,
    checkpoint: str,
    n_buckets: int = buckets.BUCKETS,
) -> StreamingQuery:
    """Write the first ``count`` rows of each group, by order within a batch and by batch.

    The rows are those of the batch cap over all that landed, however it is split
    into micro-batches, if the order is total and later batches come later in it.
    Rows are read with :func:`snapmart.streaming.jobs.read_first_seen`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        accept_capped(batch, batch_id, groups, order, count, root, n_buckets)

    return run_available(stream, checkpoint, handle)


@dataclass(frozen=True)
class Totals:
    """What is kept of each key.

    ``rows`` counts its rows, and for columns c there are ``sum_c``, ``min_c``,
    ``max_c`` and ``distinct_c`` (different values that are not null).  Sums are
    exact for whole numbers and decimals; those of floating point numbers
    depend on the split into batches in their last digits.
    """

    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    least: tuple[str, ...] = ()
    greatest: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()

    @property
    def counted(self) -> list[str]:
        return ["rows", *(f"distinct_{c}" for c in self.distinct)]

    def part(self, batch: DataFrame, fresh: dict[str, DataFrame]) -> DataFrame:
        """What a batch adds; ``fresh`` has rows of keys and values that are new to them."""
        own = batch.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.sum(c).alias(f"sum_{c}") for c in self.sums),
            *(F.min(c).alias(f"min_{c}") for c in self.least),
            *(F.max(c).alias(f"max_{c}") for c in self.greatest),
        )
        counts = [
            fresh[c].groupBy(*self.keys).agg(F.count(F.lit(1)).alias(f"distinct_{c}"))
            for c in self.distinct
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts, own)

    def added_up(self, rows: DataFrame) -> DataFrame:
        """One row for each key; its columns keep their types."""
        made = []
        for field in rows.schema:
            if field.name in self.keys:
                continue
            how = {"min": F.min, "max": F.max}.get(field.name.split("_")[0], F.sum)
            made.append(how(field.name).cast(field.dataType).alias(field.name))
        return rows.groupBy(*self.keys).agg(*made)


def add_batch(
    batch: DataFrame, batch_id: int, totals: Totals, root: str, n_buckets: int = buckets.BUCKETS
) -> None:
    """Add a batch to the totals; added again, it replaces itself."""
    spark, keys, state = batch.sparkSession, list(totals.keys), f"{root}/totals"
    base = _base(spark, state, batch_id, n_buckets)
    batch = batch.persist()
    try:
        fresh = {}
        for column in totals.distinct:
            ids = [*keys, column]
            values = batch.select(*ids).where(F.col(column).isNotNull())
            folder = f"{root}/distinct_{column}"
            fresh[column] = accept_first(values, batch_id, ids, ids, folder, n_buckets)
        part = totals.added_up(totals.part(batch, fresh))
        buckets.add_rows(part, state, keys, base, batch_id, totals.added_up)
    finally:
        batch.unpersist()


def start_totals(
    stream: DataFrame,
    totals: Totals,
    root: str,
    checkpoint: str,
    n_buckets: int = buckets.BUCKETS,
) -> StreamingQuery:
    """Keep totals per key up to date; distinct values are counted when first seen.

    A micro-batch is reduced to one row per key and adds these; of known values
    it opens the buckets that its own fall into.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, batch_id, totals, root, n_buckets)

    return run_available(stream, checkpoint, handle)


def read_totals(
    spark: SparkSession, totals: Totals, schema: T.StructType, root: str, upto: int | None = None
) -> DataFrame:
    """The totals after a batch, or after the newest; no rows before the first one."""
    empty = spark.createDataFrame([], schema)
    like = totals.part(empty, {c: empty for c in totals.distinct}).schema
    newest = buckets.latest_manifest(spark, f"{root}/totals", upto)
    rows = buckets.read_parts(spark, f"{root}/totals", newest.parts if newest else [], like)
    return totals.added_up(rows).withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in totals.counted}
    )
