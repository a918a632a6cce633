"""Merges into the four masters, counters and run report."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.operators import reports
from snapmart.operators.merge import (
    STATUS,
    merge_counters,
    merge_master,
    merge_small_batch,
    reduce_batch,
)
from snapmart.plans import posts, products, shorts, videos
from snapmart.registry import registered, views
from snapmart.registry.views import LINE_ORDER, ORDER_SPLIT, SPLIT

PRODUCT_ORDER = (*LINE_ORDER, "l_orderkey")
SHORT_ORDER = ("o_orderdate", "o_orderkey")


def _post_parts(spark, sf_dir):
    seen = views.post_observations(spark, sf_dir)
    master = reduce_batch(views.before(seen, "l_shipdate", SPLIT), posts.POLICY, LINE_ORDER)
    return master, views.since(seen, "l_shipdate", SPLIT)


def _video_parts(spark, sf_dir):
    seen = views.video_observations(spark, sf_dir)
    master = reduce_batch(views.before(seen, "l_shipdate", SPLIT), videos.POLICY, LINE_ORDER)
    return master, views.since(seen, "l_shipdate", SPLIT)


def _product_parts(spark, sf_dir):
    seen = views.product_observations(spark, sf_dir)
    old = views.before(seen, "l_shipdate", SPLIT)
    master = reduce_batch(old, products.POLICY, PRODUCT_ORDER)
    return master, views.since(seen, "l_shipdate", SPLIT)


def short_parts(spark, sf_dir):
    seen = views.short_observations(spark, sf_dir)
    old = views.before(seen, "o_orderdate", ORDER_SPLIT)
    master = reduce_batch(old, shorts.POLICY, SHORT_ORDER)
    return master, views.since(seen, "o_orderdate", ORDER_SPLIT)


def _edges_sql(table: str, key: str, moment: str, split: str, order: str) -> str:
    """First and last row per key of the old and the new part (key 0 counts as no key)."""
    return f"""
parts AS (SELECT *, {moment} < TIMESTAMP '{split}' AS is_old FROM {table} WHERE {key} <> 0),
edges AS (
  SELECT {key} AS k,
         arg_min(parts, ({order})) FILTER (is_old) AS old_first,
         arg_max(parts, ({order})) FILTER (is_old) AS old_last,
         arg_min(parts, ({order})) FILTER (NOT is_old) AS new_first,
         arg_max(parts, ({order})) FILTER (NOT is_old) AS new_last
  FROM parts GROUP BY 1),
chosen AS (
  SELECT *, coalesce(old_first, new_first) AS i, coalesce(new_last, old_last) AS w FROM edges)"""


_LINES = "l_shipdate, l_linenumber, l_partkey, l_suppkey"

_POST_SETS_SQL = """
sets AS (
  SELECT l_orderkey AS k,
         coalesce(list_sort(list(DISTINCT l_returnflag) FILTER (l_returnflag <> 'N')), []) AS kws,
         coalesce(list_sort(list(DISTINCT l_returnflag)
                  FILTER (l_returnflag <> 'N' AND is_old)), []) AS old_kws
  FROM parts GROUP BY 1)"""

_POST_STATUS_SQL = """CASE WHEN old_first IS NULL THEN 'inserted' WHEN new_last IS NULL THEN 'untouched'
            WHEN old_last.l_shipdate <> new_last.l_shipdate OR kws <> old_kws THEN 'changed'
            ELSE 'matched' END"""

_MERGE_POSTS_SQL = f"""
WITH {_edges_sql("lineitem", "l_orderkey", "l_shipdate", SPLIT, _LINES)}, {_POST_SETS_SQL}
SELECT chosen.k AS post_id, 'supplier ' || i.l_suppkey AS author_name,
       CAST(i.l_suppkey AS VARCHAR) AS author_id, 'part ' || i.l_partkey AS content,
       'u' || i.l_partkey || ',v' || i.l_suppkey AS media,
       CASE WHEN i.l_returnflag <> 'R' THEN i.l_shipdate END AS created_at,
       i.l_linestatus AS category, CAST(i.l_linenumber AS VARCHAR) AS native_post_id,
       w.l_shipdate AS scraped_at, strftime(w.l_shipdate, '%Y-%m-%dT%H:%M') AS crawl_session_id,
       array_to_string(kws, ',') AS keywords, {_POST_STATUS_SQL} AS merge_status
FROM chosen JOIN sets ON chosen.k = sets.k"""


@registered("merge_posts", _MERGE_POSTS_SQL)
def merge_posts(spark, sf_dir):
    master, batch = _post_parts(spark, sf_dir)
    return merge_master(master, batch, posts.POLICY, LINE_ORDER).select(
        "post_id",
        "author_name",
        "author_id",
        "content",
        F.array_join("media_urls", ",").alias("media"),
        "created_at",
        "category",
        F.col("platform_data.native_post_id").alias("native_post_id"),
        "scraped_at",
        "crawl_session_id",
        F.array_join("matched_keywords", ",").alias("keywords"),
        STATUS,
    )


MERGE_VIDEOS_SQL = f"""
WITH {_edges_sql("lineitem", "l_orderkey", "l_shipdate", SPLIT, _LINES)}
SELECT k AS video_id, 'part ' || i.l_partkey AS title, CAST(i.l_suppkey AS VARCHAR) AS channel_id,
       CAST(i.l_shipdate AS DATE) AS published_at, i.l_returnflag AS category,
       i.l_returnflag || ', ' || i.l_linestatus AS tags,
       CAST(i.l_shipdate AS DATE) AS first_crawl_date,
       CAST(w.l_quantity AS BIGINT) AS views, CAST(w.l_linenumber AS BIGINT) AS likes,
       CAST(floor(w.l_extendedprice / 1000) AS BIGINT) AS comments,
       CAST(date_trunc('month', w.l_shipdate) AS DATE) AS last_crawl_date,
       CASE WHEN old_first IS NULL THEN 'inserted' WHEN new_last IS NULL THEN 'untouched'
            WHEN old_last.l_quantity <> new_last.l_quantity
              OR old_last.l_linenumber <> new_last.l_linenumber
              OR floor(old_last.l_extendedprice / 1000) <> floor(new_last.l_extendedprice / 1000)
              OR date_trunc('month', old_last.l_shipdate) <> date_trunc('month', new_last.l_shipdate)
            THEN 'changed' ELSE 'matched' END AS merge_status
FROM chosen"""


@registered("merge_videos", MERGE_VIDEOS_SQL)
def merge_videos(spark, sf_dir):
    master, batch = _video_parts(spark, sf_dir)
    return merge_small_batch(master, batch, videos.POLICY, LINE_ORDER).drop(
        "channel_title", "platform"
    )


@registered(
    "merge_products",
    f"""
WITH {_edges_sql("lineitem", "l_partkey", "l_shipdate", SPLIT, _LINES + ", l_orderkey")}
SELECT k AS itemid, i.l_suppkey AS shopid, 'part ' || i.l_partkey AS name,
       i.l_extendedprice * (1.0::DOUBLE - i.l_discount) AS price,
       i.l_extendedprice AS price_before_discount,
       CAST(i.l_quantity * i.l_linenumber AS BIGINT) AS sold_total,
       i.l_linestatus = 'O' AS flash_sale, strftime(i.l_shipdate, '%Y-%m-%d') AS ctime,
       i.l_returnflag AS category, i.l_shipdate AS first_day_crawling,
       w.l_shipdate AS last_day_crawling,
       CASE WHEN old_first IS NULL THEN 'inserted' WHEN new_last IS NULL THEN 'untouched'
            WHEN old_last.l_shipdate <> new_last.l_shipdate THEN 'changed'
            ELSE 'matched' END AS merge_status
FROM chosen""",
)
def merge_products(spark, sf_dir):
    master, batch = _product_parts(spark, sf_dir)
    return merge_master(master, batch, products.POLICY, PRODUCT_ORDER).select(
        "itemid",
        "shopid",
        "name",
        "price",
        "price_before_discount",
        "sold_total",
        "flash_sale",
        "ctime",
        "category",
        "first_day_crawling",
        "last_day_crawling",
        STATUS,
    )


@registered(
    "merge_shorts",
    f"""
WITH {_edges_sql("orders", "o_custkey", "o_orderdate", ORDER_SPLIT, "o_orderdate, o_orderkey")}
SELECT k AS id, i.o_orderstatus AS author_username, i.o_orderpriority AS author_nickname,
       strftime(i.o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       'order ' || i.o_orderkey AS caption, i.o_orderpriority AS category,
       i.o_orderdate AS first_day_crawling, w.o_orderdate AS last_day_crawling,
       CASE WHEN old_first IS NULL THEN 'inserted' WHEN new_last IS NULL THEN 'untouched'
            WHEN old_last.o_orderdate <> new_last.o_orderdate THEN 'changed'
            ELSE 'matched' END AS merge_status
FROM chosen""",
)
def merge_shorts(spark, sf_dir):
    master, batch = short_parts(spark, sf_dir)
    return merge_small_batch(master, batch, shorts.POLICY, SHORT_ORDER)


@registered(
    "merge_counters",
    f"""
WITH {_edges_sql("lineitem", "l_orderkey", "l_shipdate", SPLIT, _LINES)}, {_POST_SETS_SQL},
marks AS (SELECT {_POST_STATUS_SQL} AS s FROM chosen JOIN sets ON chosen.k = sets.k)
SELECT count(*) FILTER (s = 'inserted') AS inserted, count(*) FILTER (s = 'changed') AS updated,
       count(*) FILTER (s IN ('changed', 'matched')) AS matched,
       (SELECT count(*) FROM parts WHERE NOT is_old) AS history_inserted,
       (SELECT count(*) FROM lineitem WHERE l_orderkey = 0 AND l_shipdate >= TIMESTAMP '{SPLIT}')
         AS errors
FROM marks""",
)
def posts_counters(spark, sf_dir):
    master, batch = _post_parts(spark, sf_dir)
    merged = merge_master(master, batch, posts.POLICY, LINE_ORDER)
    return merge_counters(merged, batch, posts.POLICY)


def _status_sql(table: str, key: str, moment: str, split: str, changed: str) -> str:
    """Counters of a merge whose only overwritten column is the moment."""
    return f"""
SELECT count(*) FILTER (n_old = 0) AS inserted, count(*) FILTER (n_old > 0 AND {changed}) AS updated,
       count(*) FILTER (n_old > 0 AND n_new > 0) AS matched,
       CAST(sum(n_new) AS BIGINT) AS history_inserted,
       (SELECT count(*) FROM {table} WHERE {key} = 0 AND {moment} >= TIMESTAMP '{split}') AS errors
FROM (SELECT {key}, count(*) FILTER ({moment} < TIMESTAMP '{split}') AS n_old,
             count(*) FILTER ({moment} >= TIMESTAMP '{split}') AS n_new
      FROM {table} WHERE {key} <> 0 GROUP BY {key})"""


_REPORT_SQL = f"""
WITH p AS ({_status_sql("lineitem", "l_partkey", "l_shipdate", SPLIT, "n_new > 0")}),
s AS ({_status_sql("orders", "o_custkey", "o_orderdate", ORDER_SPLIT, "n_new > 0")}),
v AS (
  SELECT count(*) FILTER (s = 'inserted') AS inserted, count(*) FILTER (s = 'changed') AS updated,
         count(*) FILTER (s IN ('changed', 'matched')) AS matched,
         (SELECT count(*) FROM lineitem WHERE l_orderkey <> 0 AND l_shipdate >= TIMESTAMP '{SPLIT}')
           AS history_inserted,
         (SELECT count(*) FROM lineitem WHERE l_orderkey = 0 AND l_shipdate >= TIMESTAMP '{SPLIT}')
           AS errors
  FROM (SELECT merge_status AS s FROM ({MERGE_VIDEOS_SQL})))"""

FAILURE = "connection reset by peer while scrolling the results of the search " + "page " * 20


def _report(spark, sf_dir):
    """Counters of products, short videos and videos; the posts' run failed before its merge."""
    parts = {
        "products": (*_product_parts(spark, sf_dir), products.POLICY, PRODUCT_ORDER),
        "shorts": (*short_parts(spark, sf_dir), shorts.POLICY, SHORT_ORDER),
        "videos": (*_video_parts(spark, sf_dir), videos.POLICY, LINE_ORDER),
    }
    rows = None
    for name, (master, batch, policy, order) in parts.items():
        merged = merge_master(master, batch, policy, order)
        row = reports.platform_row(name, merge_counters(merged, batch, policy))
        rows = row if rows is None else rows.unionByName(row)
    nothing = merge_counters(merged.limit(0), batch.limit(0), videos.POLICY)
    return rows.unionByName(reports.platform_row("posts", nothing, FAILURE))


@registered(
    "run_report",
    f"""{_REPORT_SQL}
SELECT 'products' AS platform, 'SUCCESS' AS status, p.* FROM p
UNION ALL SELECT 'shorts', 'SUCCESS', s.* FROM s
UNION ALL SELECT 'videos', 'SUCCESS', v.* FROM v
UNION ALL SELECT 'posts', 'FAILED: ' || substr('{FAILURE}', 1, 100), 0, 0, 0, 0, 0""",
)
def run_report(spark, sf_dir):
    return _report(spark, sf_dir)


@registered(
    "run_report_total",
    f"""{_REPORT_SQL}
SELECT CAST(sum(inserted) AS BIGINT) AS total_inserted,
       CAST(sum(matched) AS BIGINT) AS total_matched,
       CAST(sum(history_inserted) AS BIGINT) AS total_history_inserted
FROM (SELECT * FROM p UNION ALL SELECT * FROM s UNION ALL SELECT * FROM v)""",
)
def run_report_total(spark, sf_dir):
    return reports.roll_up(
        _report(spark, sf_dir), ["inserted", "matched", "history_inserted"]
    )


@registered(
    "counters_by_category",
    f"""
WITH {_edges_sql("orders", "o_custkey", "o_orderdate", ORDER_SPLIT, "o_orderdate, o_orderkey")}
SELECT i.o_orderpriority AS category, count(*) FILTER (old_first IS NULL) AS inserted,
       count(*) FILTER (old_first IS NOT NULL AND new_first IS NOT NULL) AS matched,
       count(*) FILTER (new_first IS NULL) AS untouched
FROM chosen GROUP BY 1""",
)
def counters_by_category(spark, sf_dir):
    master, batch = short_parts(spark, sf_dir)
    merged = merge_master(master, batch, shorts.POLICY, SHORT_ORDER)
    return reports.status_by_category(merged, "category")
