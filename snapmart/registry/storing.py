"""History, catalog tables, exports, versioned masters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from snapmart import settings
from snapmart.operators.dedup import keep_first
from snapmart.operators.merge import STATUS, merge_small_batch
from snapmart.operators.ranking import top
from snapmart.plans import shorts
from snapmart.registry import registered, views
from snapmart.registry.merging import SHORT_ORDER, short_parts
from snapmart.sources import tables
from snapmart.workspace import new_folder

EVENT_SPLIT = "2024-01-16 00:00:00"


@registered(
    "append_history",
    """
SELECT event_id, user_id, event_type, value, ts AS crawl_date, CAST(ts AS DATE) AS crawl_day
FROM events""",
)
def append_history(spark, sf_dir):
    """Two runs appended to one history, read back."""
    path = new_folder(spark, "history")
    observed = views.load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").alias("crawl_date")
    )
    for run in (views.before, views.since):
        tables.append_history(run(observed, "crawl_date", EVENT_SPLIT), path, "crawl_date")
    return spark.read.parquet(path)


@registered(
    "catalog_roundtrip",
    """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders""",
)
def catalog_roundtrip(spark, sf_dir):
    """A master saved in a platform's namespace and read back by name."""
    namespace = f"posts_{uuid.uuid4().hex[:12]}"
    tables.create_namespace(spark, namespace, new_folder(spark, namespace))
    orders = views.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    master = settings.POST_TABLES[0]
    tables.save_table(orders, namespace, master)
    kept = new_folder(spark, "catalog")
    tables.table(spark, namespace, master).write.parquet(kept)
    tables.drop_namespace(spark, namespace)
    return spark.read.parquet(kept)


@registered(
    "export_json",
    """
SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
  FROM orders) WHERE place = 1""",
)
def export_json(spark, sf_dir):
    """De-duplicated records as JSON Lines, read back."""
    path = new_folder(spark, "export")
    orders = views.load(spark, sf_dir, "orders")
    first = keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice"
    )
    tables.export_json(first, path)
    return spark.read.schema(first.schema).json(path)


@registered(
    "master_versions",
    """
SELECT o_custkey AS id, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
       min(o_orderdate) AS first_day_crawling, max(o_orderdate) AS last_day_crawling
FROM orders WHERE o_custkey <> 0 GROUP BY 1""",
)
def master_versions(spark, sf_dir):
    """Version 0 from the old part, version 1 merged from it, newest one read."""
    root = new_folder(spark, "master")
    master, batch = short_parts(spark, sf_dir)
    tables.write_version(master, root, 0)
    old = tables.read_version(spark, root, tables.latest_version(spark, root))
    merged = merge_small_batch(old, batch, shorts.POLICY, SHORT_ORDER)
    tables.write_version(merged.drop(STATUS), root, 1)
    newest = tables.read_version(spark, root, tables.latest_version(spark, root))
    return newest.select(
        "id",
        F.split_part("caption", F.lit(" "), F.lit(2)).cast("bigint").alias("first_order"),
        "first_day_crawling",
        "last_day_crawling",
    )


@registered(
    "trending_written_history",
    """
SELECT event_id, user_id, event_type, value, crawl_date FROM (
  SELECT event_id, user_id, event_type, value, ts AS crawl_date FROM events
  WHERE ts >= TIMESTAMP '2024-01-20 12:00:00')
ORDER BY value DESC, event_id LIMIT 20""",
)
def trending_written_history(spark, sf_dir):
    """The highest values since a moment, of a history whose older days are not opened."""
    path = new_folder(spark, "history")
    observed = views.load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").alias("crawl_date")
    )
    tables.append_history(observed, path, "crawl_date")
    recent = tables.read_history(spark, path, "crawl_date", "2024-01-20 12:00:00")
    return top(recent, "value", ["event_id"], 20).drop(tables.DAY_COLUMN)
