"""Ranked lists, newest snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.operators.latest import attach_global_latest, attach_latest, latest_per_key
from snapmart.operators.merge import reduce_batch
from snapmart.operators.ranking import top, with_rank
from snapmart.functions.numbers import with_separators
from snapmart.plans import posts, products, shorts, videos
from snapmart.registry import registered
from snapmart.registry import views
from snapmart.registry.views import (
    EVENT_NUMBER_SQL,
    LATEST_SQL,
    LINE_ORDER,
    METRICS_SQL,
    POSTS_SQL,
    TIES,
)

AS_OF = "2001-08-01 00:00:00"

POST_COLUMNS = (
    "post_id",
    "author_id",
    "created_at",
    "category",
    "latest_metrics.snapshot_time",
    "latest_metrics.likes",
    "latest_metrics.comments",
    "latest_metrics.shares",
    "total_engagement",
)


def _trending_posts_sql(extra: str, bound: int) -> str:
    return f"""
WITH {POSTS_SQL}, {METRICS_SQL}, {LATEST_SQL}
SELECT p.post_id, p.author_id, p.created_at, p.category, m.snapshot_time, m.likes, m.comments,
       m.shares, m.likes + m.comments + m.shares AS total_engagement
FROM posts p JOIN latest m ON p.post_id = m.post_id
WHERE p.created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR {extra}
  AND m.likes + m.comments + m.shares >= {bound}
ORDER BY total_engagement DESC, p.post_id LIMIT 20"""


@registered("trending_posts", _trending_posts_sql("", 50))
def trending_posts(spark, sf_dir):
    return posts.trending(
        views.posts(spark, sf_dir),
        views.metrics(spark, sf_dir),
        AS_OF,
        hours=168,
        min_engagement=50,
        ties=TIES,
    ).select(*POST_COLUMNS)


@registered("trending_posts_threshold", _trending_posts_sql("", 111))
def trending_posts_threshold(spark, sf_dir):
    return posts.trending(
        views.posts(spark, sf_dir),
        views.metrics(spark, sf_dir),
        AS_OF,
        hours=168,
        min_engagement=111,
        ties=TIES,
    ).select(*POST_COLUMNS)


@registered("trending_posts_category", _trending_posts_sql("AND p.category = '2-HIGH'", 5))
def trending_posts_category(spark, sf_dir):
    return posts.trending(
        views.posts(spark, sf_dir),
        views.metrics(spark, sf_dir),
        AS_OF,
        category="2-HIGH",
        hours=168,
        min_engagement=5,
        ties=TIES,
    ).select(*POST_COLUMNS)


@registered(
    "trending_videos",
    """
WITH obs AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS f,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS b
  FROM lineitem WHERE l_orderkey <> 0),
master AS (
  SELECT x.l_orderkey AS video_id, 'part ' || x.l_partkey AS title,
         'supplier ' || x.l_suppkey AS channel_title, x.l_returnflag AS category,
         CAST(y.l_quantity AS BIGINT) AS views, CAST(y.l_linenumber AS BIGINT) AS likes,
         CAST(floor(y.l_extendedprice / 1000) AS BIGINT) AS comments,
         CAST(x.l_shipdate AS DATE) AS published_at
  FROM obs x JOIN obs y ON x.l_orderkey = y.l_orderkey WHERE x.f = 1 AND y.b = 1)
SELECT * FROM master WHERE views >= 10 AND category = 'A'
ORDER BY views DESC, video_id LIMIT 20""",
)
def trending_videos(spark, sf_dir):
    master = reduce_batch(views.video_observations(spark, sf_dir), videos.POLICY, LINE_ORDER)
    return videos.trending(master, category="A", min_views=10)


def _history(spark, sf_dir):
    return views.load(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("author_username"),
        F.col("event_type").alias("author_nickname"),
        F.col("props").alias("caption"),
        F.col("event_type").alias("category"),
        views.cents("value").alias("views"),
        views.event_number().alias("likes"),
        F.col("event_id").alias("comments"),
        F.length("props").cast("bigint").alias("shares"),
        F.col("ts").alias("crawl_date"),
    )


_HISTORY_SQL = f"""
history AS (
  SELECT user_id AS id, 'user ' || user_id AS author_username, event_type AS author_nickname,
         props AS caption, event_type AS category, CAST(round(value * 100) AS BIGINT) AS views,
         {EVENT_NUMBER_SQL} AS likes, event_id AS comments,
         CAST(length(props) AS BIGINT) AS shares, ts AS crawl_date
  FROM events)"""


@registered(
    "trending_history",
    f"""
WITH {_HISTORY_SQL}
SELECT * FROM history
WHERE crawl_date >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR AND views >= 1000
ORDER BY views DESC, id, crawl_date LIMIT 20""",
)
def trending_history(spark, sf_dir):
    return shorts.trending(_history(spark, sf_dir), "2024-01-31 00:00:00")


@registered(
    "trending_history_deduped",
    f"""
WITH {_HISTORY_SQL}, best AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY views DESC, crawl_date DESC) AS place
  FROM history
  WHERE crawl_date >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 336 HOUR
    AND views >= 1000 AND category = 'click')
SELECT * EXCLUDE (place) FROM best WHERE place = 1
ORDER BY views DESC, id, crawl_date LIMIT 20""",
)
def trending_history_deduped(spark, sf_dir):
    return shorts.trending(
        _history(spark, sf_dir), "2024-01-31 00:00:00", category="click", hours=336, dedupe=True
    )


@registered(
    "trending_products",
    """
WITH first_seen AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey
           ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_orderkey) AS place
  FROM lineitem WHERE l_partkey <> 0),
master AS (
  SELECT l_partkey AS itemid, 'part ' || l_partkey AS name,
         l_extendedprice * (1.0::DOUBLE - l_discount) AS price,
         CASE WHEN l_extendedprice > 0 THEN
           CAST(round_even((l_extendedprice - l_extendedprice * (1.0::DOUBLE - l_discount))
                / l_extendedprice * 100, 0) AS BIGINT) || '%' ELSE '0%' END AS discount,
         CAST(l_quantity * l_linenumber AS BIGINT) AS sold_total,
         round_even(l_tax * 10, 2) AS rating_star, l_returnflag AS category
  FROM first_seen WHERE place = 1)
SELECT * FROM master WHERE sold_total >= 100 ORDER BY sold_total DESC, itemid LIMIT 20""",
)
def trending_products(spark, sf_dir):
    seen = views.product_observations(spark, sf_dir)
    master = reduce_batch(seen, products.POLICY, [*LINE_ORDER, "l_orderkey"])
    return products.trending(master)


SNAPSHOT = ("snapshot_time", "likes", "comments", "shares")
ATTACHED = tuple(f"latest_metrics.{c}" for c in SNAPSHOT)


@registered(
    "latest_snapshot",
    f"""
WITH {METRICS_SQL}, {LATEST_SQL}
SELECT post_id, snapshot_time, likes, comments, shares FROM latest""",
)
def latest_snapshot(spark, sf_dir):
    newest = latest_per_key(views.metrics(spark, sf_dir), "post_id", "snapshot_time", TIES)
    return newest.select("post_id", *SNAPSHOT)


@registered(
    "posts_with_latest",
    f"""
WITH {POSTS_SQL}, {METRICS_SQL}, {LATEST_SQL}
SELECT p.*, m.snapshot_time, m.likes, m.comments, m.shares
FROM posts p JOIN latest m ON p.post_id = m.post_id""",
)
def posts_with_latest(spark, sf_dir):
    return attach_latest(
        views.posts(spark, sf_dir), views.metrics(spark, sf_dir), "post_id", "snapshot_time", TIES
    ).select("post_id", "author_id", "created_at", "category", *ATTACHED)


@registered(
    "attach_global_latest",
    f"""
WITH {POSTS_SQL}, {METRICS_SQL}, newest AS (
  SELECT snapshot_time, likes, comments, shares FROM metrics
  ORDER BY snapshot_time DESC, comments DESC, tie_1 DESC, tie_2 DESC, post_id DESC LIMIT 1)
SELECT posts.*, newest.* FROM posts, newest""",
)
def global_latest(spark, sf_dir):
    return attach_global_latest(
        views.posts(spark, sf_dir), views.metrics(spark, sf_dir), "post_id", "snapshot_time", TIES
    ).select("post_id", "author_id", "created_at", "category", *ATTACHED)


@registered(
    "rank_report",
    """
WITH best AS (
  SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS views
  FROM events ORDER BY views DESC, event_id LIMIT 5)
SELECT row_number() OVER (ORDER BY views DESC, event_id) AS rank, event_id, user_id, event_type,
       format('{:,}', views) AS views_shown
FROM best""",
)
def rank_report(spark, sf_dir):
    scored = views.load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", views.cents("value").alias("views")
    )
    ranked = with_rank(top(scored, "views", ["event_id"], 5), "views", ["event_id"])
    return ranked.select(
        "rank", "event_id", "user_id", "event_type", with_separators("views").alias("views_shown")
    )
