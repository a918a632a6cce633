"""Late responses beside the requests they answer, as a stream-stream join.

A response takes the category of its own request, whichever is asked for when it
arrives and whichever of the two lands first.  Both sides have a watermark, so
what waits in the state is bounded: a request is forgotten once no response in
time can come any more, a response without a request is given up once no
request before it can come any more, and is passed on as an orphan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart.sources import tables
from snapmart.streaming.jobs import BATCH, run_available

MATCHED, ORPHAN = "matched", "orphan"


class RowsTooLate(RuntimeError):
    """Rows came behind the watermark and were left out; the delay is too short."""


def answered(
    requests: DataFrame,
    responses: DataFrame,
    key: str,
    asked: str,
    arrived: str,
    within: str,
    delay: str,
) -> DataFrame:
    """Each response with the columns of its request and its ``status``.

    A request counts for responses from its own moment (``asked``) until
    ``within`` later; other responses are orphans with nulls in the request's
    columns, as are responses with a null key.  Keys are unique among requests.
    ``delay`` is how far behind the newest row of its side a row may land.
    Works on batches as on streams.
    """
    asks = requests.withWatermark(asked, delay).withColumnRenamed(key, "_asked_key")
    got = responses.withWatermark(arrived, delay)
    in_time = (
        (F.col("_asked_key") == F.col(key))
        & (F.col(arrived) >= F.col(asked))
        & (F.col(arrived) <= F.col(asked) + F.expr(f"INTERVAL {within}"))
    )
    return got.join(asks, in_time, "left_outer").select(
        *responses.columns,
        *(c for c in requests.columns if c != key),
        F.when(F.col("_asked_key").isNull(), ORPHAN).otherwise(MATCHED).alias("status"),
    )


def closing_rows(template: DataFrame, key: str, moment: str, at: str) -> DataFrame:
    """One row at a moment beyond all others, which ends the waiting; nulls but for a key.

    It lands on both sides twice, in two micro-batches: the first moves the
    watermark, under the second all that still waits is passed on.  ``template``
    is any frame with the side's columns.
    """
    # Without a key the row would not get as far as the watermark of the requests.
    known = {moment: F.lit(at), key: F.lit("0")}
    return template.sparkSession.range(1).select(
        *(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in template.schema.fields)
    )


def start_answered(
    joined: DataFrame, matched: str, orphans: str, checkpoint: str, arrived: str, closed_at: str
) -> StreamingQuery:
    """Write matched responses and orphans to folders of their own, by micro-batch.

    A replayed batch replaces what it wrote.  Rows from ``closed_at`` on are
    closing rows and not written.
    """
    end = F.lit(closed_at).cast(joined.schema[arrived].dataType)

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.where(F.col(arrived) < end).persist()
        try:
            for status, root in ((MATCHED, matched), (ORPHAN, orphans)):
                part = held.where(F.col("status") == status)
                tables.write_history_batch(part, root, batch_id)
        finally:
            held.unpersist()

    return run_available(joined, checkpoint, handle)


def finished(query: StreamingQuery) -> StreamingQuery:
    """The query once it has ended; an error if a row was left out as too late."""
    query.awaitTermination()
    late = sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
    if late:
        raise RowsTooLate(f"{late} rows landed behind the watermark")
    return query


def read_written(spark: SparkSession, schema: T.StructType, root: str) -> DataFrame:
    """What was written below a root so far; no rows before the first batch."""
    found = tables.read_if_any(spark, root, T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    return spark.createDataFrame([], schema) if found is None else found.drop(BATCH)
