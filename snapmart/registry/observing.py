"""Keep-first, caps, known-id tests, detail lookup, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.operators import dedup, reports
from snapmart.operators.filters import exclude_channels
from snapmart.operators.lookups import hits_with_details
from snapmart.registry import registered, views
from snapmart.registry.views import SPLIT


@registered(
    "dedup_first",
    """
SELECT event_id, user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS place
  FROM events) WHERE place = 1""",
)
def dedup_first(spark, sf_dir):
    events = views.load(spark, sf_dir, "events")
    first = dedup.keep_first(events, ["user_id"], ["event_id"], scope=["event_type"])
    return first.select("event_id", "user_id", "event_type", "ts", "value")


@registered(
    "dedup_whole_run",
    """
SELECT o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
  FROM orders) WHERE place = 1""",
)
def dedup_whole_run(spark, sf_dir):
    orders = views.load(spark, sf_dir, "orders")
    first = dedup.keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_orderpriority")


def _cap_sql(count: int) -> str:
    return f"""
SELECT event_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place
  FROM events) WHERE place <= {count}"""


@registered("cap_per_keyword", _cap_sql(400))
def cap_per_keyword(spark, sf_dir):
    events = views.load(spark, sf_dir, "events")
    return dedup.cap_per_group(events, ["event_type"], ["event_id"], 400).select(
        "event_id", "event_type", "ts"
    )


@registered("cap_per_keyword_large", _cap_sql(1500))
def cap_per_keyword_large(spark, sf_dir):
    events = views.load(spark, sf_dir, "events")
    return dedup.cap_per_group(events, ["event_type"], ["event_id"], 1500).select(
        "event_id", "event_type", "ts"
    )


@registered(
    "not_seen",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{SPLIT}' AND l_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT}')""",
)
def not_seen(spark, sf_dir):
    line = views.load(spark, sf_dir, "lineitem")
    known = views.before(line, "l_shipdate", SPLIT)
    fresh = dedup.not_seen(views.since(line, "l_shipdate", SPLIT), known, "l_orderkey")
    return fresh.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@registered(
    "new_vs_existing",
    f"""
WITH known AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT}'),
batch AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SPLIT}')
SELECT b.l_orderkey, k.l_orderkey IS NOT NULL AS is_known
FROM batch b LEFT JOIN known k ON b.l_orderkey = k.l_orderkey""",
)
def new_vs_existing(spark, sf_dir):
    line = views.load(spark, sf_dir, "lineitem")
    return dedup.split_known(
        views.since(line, "l_shipdate", SPLIT),
        views.before(line, "l_shipdate", SPLIT),
        "l_orderkey",
    )


@registered(
    "hits_with_details",
    """
WITH hits AS (
  SELECT l_returnflag AS query, l_partkey AS p_partkey, l_orderkey, l_shipdate,
         row_number() OVER (PARTITION BY l_returnflag, l_partkey
           ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_orderkey) AS place
  FROM lineitem)
SELECT h.query, h.p_partkey, h.l_orderkey, h.l_shipdate, p.p_name, p.p_brand
FROM hits h JOIN part p ON h.p_partkey = p.p_partkey
WHERE h.place = 1 AND lower(p.p_brand) NOT LIKE '%brand#1%'""",
)
def hits_with_part_details(spark, sf_dir):
    hits = views.load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("query"),
        F.col("l_partkey").alias("p_partkey"),
        "l_orderkey",
        "l_shipdate",
        "l_linenumber",
        "l_suppkey",
    )
    parts = views.load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    order = ["l_shipdate", "l_linenumber", "p_partkey", "l_suppkey", "l_orderkey"]
    details = exclude_channels(parts, "p_brand", ["brand#1"])
    found = hits_with_details(hits, details, "p_partkey", order, scope=["query"])
    return found.select("query", "p_partkey", "l_orderkey", "l_shipdate", "p_name", "p_brand")


@registered(
    "keyword_counts",
    """
SELECT k.event_type, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES ('click'), ('view'), ('signup'), ('purchase'), ('refund')) k(event_type)
LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) c
  ON k.event_type = c.event_type""",
)
def keyword_counts(spark, sf_dir):
    events = views.load(spark, sf_dir, "events")
    keywords = ["click", " view ", "signup", "", "  ", "purchase", "refund"]
    return reports.counts_per_keyword(events, keywords, "event_type")


@registered(
    "run_totals",
    """
SELECT count(*) AS total_records, count(DISTINCT l_orderkey) AS distinct_records FROM lineitem""",
)
def run_totals(spark, sf_dir):
    return reports.totals(views.load(spark, sf_dir, "lineitem"), "l_orderkey")


@registered(
    "first_last_seen",
    """
SELECT l_partkey, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen
FROM lineitem GROUP BY l_partkey""",
)
def first_last_seen(spark, sf_dir):
    line = views.load(spark, sf_dir, "lineitem")
    return reports.first_last_seen(line, "l_partkey", "l_shipdate")


