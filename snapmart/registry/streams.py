"""Streaming jobs over the events table as a stream of landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.functions import times
from snapmart.operators.merge import MergePolicy, read_buckets
from snapmart.plans import products
from snapmart.registry import CHECKS, bodies, registered, views
from snapmart.registry import flattening as _flattening  # noqa: F401  (its SQL is reused)
from snapmart.streaming import jobs, requests, running
from snapmart.workspace import new_folder


def _landed(spark, sf_dir):
    # A pattern, because a file stream takes no single file as its folder.
    schema = views.load(spark, sf_dir, "events").schema
    landed = jobs.read_landed(spark, f"{sf_dir}/event[s].parquet", schema)
    return landed.withColumn("at", times.as_utc_instant(F.col("ts")))


@registered(
    "stream_dedup",
    """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS place
  FROM events) WHERE place = 1""",
)
def stream_dedup(spark, sf_dir):
    """First event per user and type, exact over all micro-batches."""
    root, checkpoint = new_folder(spark, "first-seen"), new_folder(spark, "checkpoint")
    stream = _landed(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    query = jobs.start_first_seen(stream, ["user_id", "event_type"], ["event_id"], root, checkpoint)
    query.awaitTermination()
    return jobs.read_first_seen(spark, root, stream.schema)


@registered(
    "stream_dedup_watermark",
    """
SELECT DISTINCT user_id, event_type FROM events""",
)
def stream_dedup_watermark(spark, sf_dir):
    """Distinct user and type with watermark state; the delay spans the whole table."""
    path, checkpoint = new_folder(spark, "distinct"), new_folder(spark, "checkpoint")
    stream = _landed(spark, sf_dir).select("user_id", "event_type", "at")
    distinct = jobs.drop_repeats(stream, ["user_id", "event_type"], "at", "60 days")
    jobs.append_available(distinct, checkpoint, path).awaitTermination()
    return spark.read.parquet(path).select("user_id", "event_type")


def _landed_bodies(spark, sf_dir):
    """Product responses written as files, then read as a stream."""
    path = new_folder(spark, "landed-bodies")
    captured = bodies.product_responses(spark, sf_dir)
    captured.write.parquet(path)
    return jobs.read_landed(spark, path, captured.schema)


@registered("stream_flatten", CHECKS["flatten_products"])
def stream_flatten(spark, sf_dir):
    """The product flattener on a stream of landed responses."""
    path, checkpoint = new_folder(spark, "flat"), new_folder(spark, "checkpoint")
    records = products.flatten(_landed_bodies(spark, sf_dir))
    flat = products.to_history_rows(records, F.col("ts"))
    jobs.append_available(flat, checkpoint, path).awaitTermination()
    return spark.read.parquet(path)


@registered("stream_products_job", CHECKS["products_job"])
def stream_products_job(spark, sf_dir):
    """Landed responses to records to history and master, per micro-batch."""
    records = products.flatten(_landed_bodies(spark, sf_dir))
    per_shop = records.where(F.col("problem").isNull()).withColumn("itemid", F.col("shopid"))
    batch = products.to_master_rows(per_shop, F.col("ts"))
    history, master = new_folder(spark, "history"), new_folder(spark, "master")
    order = ["seq", "pos"]
    query = jobs.start_merge(
        batch, products.POLICY, order, history, master, new_folder(spark, "checkpoint")
    )
    query.awaitTermination()
    upto = query.lastProgress["batchId"]
    return jobs.current_master(
        spark, products.POLICY, order, batch.schema, history, master, upto
    ).select(
        "itemid", "name", "sold_total", "category", "first_day_crawling", "last_day_crawling"
    )


STREAM_POLICY = MergePolicy(
    key="user_id",
    insert_only=("first_type", "first_seen"),
    overwrite=("last_value", "last_seen"),
    add_to_set={"types": "event_type"},
)


@registered(
    "stream_merge",
    """
SELECT user_id, arg_min(event_type, event_id) AS first_type, min(ts) AS first_seen,
       arg_max(value, event_id) AS last_value, max(ts) AS last_seen,
       array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types
FROM events WHERE user_id <> 0 GROUP BY user_id""",
)
def stream_merge(spark, sf_dir):
    """History appended and master folded per micro-batch; the final master."""
    history, master = new_folder(spark, "history"), new_folder(spark, "master")
    stream = _landed(spark, sf_dir).select(
        "event_id",
        "user_id",
        "event_type",
        F.col("event_type").alias("first_type"),
        F.col("ts").alias("first_seen"),
        F.col("value").alias("last_value"),
        F.col("ts").alias("last_seen"),
    )
    query = jobs.start_merge(
        stream, STREAM_POLICY, ["event_id"], history, master, new_folder(spark, "checkpoint")
    )
    query.awaitTermination()
    upto = query.lastProgress["batchId"]
    folded = jobs.current_master(
        spark, STREAM_POLICY, ["event_id"], stream.schema, history, master, upto
    )
    return folded.withColumn("types", F.array_join("types", ","))


# Files that land one after the other; every key and every seq occurs in several of them.
PARTS = 4


def _landed_parts(spark, sf_dir):
    """The events in ``PARTS`` files, one micro-batch each; ``seq`` starts anew in each file."""
    path = new_folder(spark, "landed-parts")
    rows = views.load(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.floor(F.col("event_id") / PARTS).cast("bigint").alias("seq"),
        F.col("event_type").alias("first_type"),
        F.col("ts").alias("first_seen"),
        F.col("value").alias("last_value"),
        F.col("ts").alias("last_seen"),
        F.pmod("event_id", F.lit(PARTS)).alias("part"),
    )
    for part in range(PARTS):
        of_part = rows.where(F.col("part") == part).drop("part")
        of_part.coalesce(1).write.mode("append").parquet(path)
    return jobs.read_landed(spark, path, of_part.schema, files_per_trigger=1)


_PARTS_SQL = f"""
SELECT user_id, arg_min(event_type, (event_id % {PARTS}, event_id // {PARTS})) AS first_type,
       arg_min(ts, (event_id % {PARTS}, event_id // {PARTS})) AS first_seen,
       arg_max(value, (event_id % {PARTS}, event_id // {PARTS})) AS last_value,
       arg_max(ts, (event_id % {PARTS}, event_id // {PARTS})) AS last_seen,
       array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types
FROM events WHERE user_id <> 0 GROUP BY user_id"""


def _merged_parts(spark, sf_dir, fold_every):
    history, master = new_folder(spark, "history"), new_folder(spark, "master")
    stream = _landed_parts(spark, sf_dir)
    query = jobs.start_merge(
        stream,
        STREAM_POLICY,
        ["seq"],
        history,
        master,
        new_folder(spark, "checkpoint"),
        fold_every,
        moment="first_seen",
    )
    query.awaitTermination()
    upto = query.lastProgress["batchId"]
    folded = jobs.current_master(
        spark, STREAM_POLICY, ["seq"], stream.schema, history, master, upto
    )
    return folded.withColumn("types", F.array_join("types", ","))


@registered("stream_merge_batches", _PARTS_SQL)
def stream_merge_batches(spark, sf_dir):
    """Several micro-batches, a master version after each."""
    return _merged_parts(spark, sf_dir, 1)


@registered("stream_merge_folded", _PARTS_SQL)
def stream_merge_folded(spark, sf_dir):
    """The same batches, a version after the third; the rest is folded in on reading."""
    return _merged_parts(spark, sf_dir, 3)


@registered("stream_merge_buckets", _PARTS_SQL)
def stream_merge_buckets(spark, sf_dir):
    """The same batches into a master in buckets, of which a batch rewrites those it hits."""
    history, master = new_folder(spark, "history"), new_folder(spark, "master")
    stream = _landed_parts(spark, sf_dir)
    jobs.start_bucketed_merge(
        stream, STREAM_POLICY, ["seq"], history, master, new_folder(spark, "checkpoint"), 16
    ).awaitTermination()
    like = spark.createDataFrame([], stream.schema)
    folded = read_buckets(spark, STREAM_POLICY, like, master)
    return folded.withColumn("types", F.array_join("types", ","))


@registered(
    "stream_dedup_batches",
    f"""
SELECT user_id, event_type, seq FROM (
  SELECT user_id, event_type, event_id // {PARTS} AS seq,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY event_id % {PARTS}, event_id // {PARTS}) AS place
  FROM events) WHERE place = 1""",
)
def stream_dedup_batches(spark, sf_dir):
    """First event per user and type over several micro-batches."""
    root, checkpoint = new_folder(spark, "first-seen"), new_folder(spark, "checkpoint")
    stream = _landed_parts(spark, sf_dir).select("user_id", "event_type", "seq")
    query = jobs.start_first_seen(stream, ["user_id", "event_type"], ["seq"], root, checkpoint)
    query.awaitTermination()
    return jobs.read_first_seen(spark, root, stream.schema)


CAP = 30


@registered(
    "stream_cap_batches",
    f"""
SELECT user_id, event_type, seq FROM (
  SELECT user_id, event_type, event_id // {PARTS} AS seq,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY event_id % {PARTS}, event_id // {PARTS}) AS place
  FROM events) WHERE place <= {CAP}""",
)
def stream_cap_batches(spark, sf_dir):
    """The first events of each user, at most ``CAP`` over all micro-batches together."""
    root, checkpoint = new_folder(spark, "capped"), new_folder(spark, "checkpoint")
    stream = _landed_parts(spark, sf_dir).select("user_id", "event_type", "seq")
    running.start_capped(stream, ["user_id"], ["seq"], CAP, root, checkpoint, 16).awaitTermination()
    return jobs.read_first_seen(spark, root, stream.schema)


def _running_totals(spark, stream, kept):
    root, checkpoint = new_folder(spark, "totals"), new_folder(spark, "checkpoint")
    running.start_totals(stream, kept, root, checkpoint, 16).awaitTermination()
    return running.read_totals(spark, kept, stream.schema, root)


@registered(
    "stream_totals",
    """
SELECT event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total,
       min(ts) AS first_seen, max(ts) AS last_seen, count(DISTINCT user_id) AS users
FROM events GROUP BY event_type""",
)
def stream_totals(spark, sf_dir):
    """Counters per event type, kept up to date by several micro-batches."""
    stream = _landed_parts(spark, sf_dir).withColumn(
        "whole", F.floor("last_value").cast("bigint")
    )
    kept = running.Totals(("event_type",), ("whole",), ("first_seen",), ("last_seen",), ("user_id",))
    return _running_totals(spark, stream, kept).select(
        "event_type",
        F.col("rows").alias("n"),
        F.col("sum_whole").alias("total"),
        F.col("min_first_seen").alias("first_seen"),
        F.col("max_last_seen").alias("last_seen"),
        F.col("distinct_user_id").alias("users"),
    )


@registered(
    "stream_run_totals",
    """
SELECT count(*) AS total_records, count(DISTINCT user_id) AS distinct_records FROM events""",
)
def stream_run_totals(spark, sf_dir):
    """All records and distinct records so far, as one row."""
    stream = _landed_parts(spark, sf_dir).withColumn("run", F.lit("all"))
    kept = running.Totals(("run",), distinct=("user_id",))
    return _running_totals(spark, stream, kept).select(
        F.col("rows").alias("total_records"), F.col("distinct_user_id").alias("distinct_records")
    )


# A response may come so long after its request; rows land out of order within the delay.
WITHIN, DELAY, CLOSED_AT = "120 MINUTES", "60 days", "9999-01-01 00:00:00"
REQUESTS_LANDED, RESPONSES_LANDED = (2, 0, 3, 1), (3, 1, 0, 2)


def _asked_and_answered(spark, sf_dir):
    """Requests (one in ten events made none) and responses up to 149 minutes later."""
    rows = views.load(spark, sf_dir, "events").withColumn("at", times.as_utc_instant(F.col("ts")))
    asked = rows.where("event_id % 10 <> 3").select(
        "event_id", F.col("event_type").alias("category"), F.col("at").alias("asked_at")
    )
    minutes = F.make_dt_interval(mins=F.pmod(F.col("user_id"), F.lit(150)).cast("int"))
    given = rows.select("event_id", F.col("value").alias("item"), (F.col("at") + minutes).alias("arrived_at"))
    return asked, given


def _landed_in_order(spark, frame, moment, order, label):
    """A stream over files that land part by part in the given order, then closing rows."""
    path = new_folder(spark, label)
    for part in order:
        of_part = frame.where(F.pmod("event_id", F.lit(len(order))) == part)
        of_part.coalesce(1).write.mode("append").parquet(path)
    closing = requests.closing_rows(frame, "event_id", moment, CLOSED_AT)
    for _ in range(2):
        closing.coalesce(1).write.mode("append").parquet(path)
    return jobs.read_landed(spark, path, frame.schema, files_per_trigger=1)


@registered(
    "late_responses",
    """
SELECT event_id, value AS item, CASE WHEN ok THEN event_type END AS category,
       CASE WHEN ok THEN 'matched' ELSE 'orphan' END AS status
FROM (SELECT *, event_id % 10 <> 3 AND user_id % 150 <= 120 AS ok FROM events)""",
)
def late_responses(spark, sf_dir):
    """Responses with the category of their own request, and those without a request."""
    asked, given = _asked_and_answered(spark, sf_dir)
    joined = requests.answered(
        _landed_in_order(spark, asked, "asked_at", REQUESTS_LANDED, "landed-requests"),
        _landed_in_order(spark, given, "arrived_at", RESPONSES_LANDED, "landed-responses"),
        "event_id",
        "asked_at",
        "arrived_at",
        WITHIN,
        DELAY,
    )
    matched, orphans = new_folder(spark, "matched"), new_folder(spark, "orphans")
    checkpoint = new_folder(spark, "checkpoint")
    requests.finished(
        requests.start_answered(joined, matched, orphans, checkpoint, "arrived_at", CLOSED_AT)
    )
    written = [requests.read_written(spark, joined.schema, root) for root in (matched, orphans)]
    return written[0].union(written[1]).select("event_id", "item", "category", "status")
