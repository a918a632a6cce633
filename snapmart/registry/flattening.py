"""Whole jobs from response bodies to records, masters and ranked lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.functions import times
from snapmart.operators.dedup import keep_first
from snapmart.operators.lookups import hits_with_details
from snapmart.operators.merge import merge_counters, merge_master, reduce_batch
from snapmart.plans import posts, products, shorts, videos
from snapmart.registry import bodies, registered
from snapmart.registry.views import EVENT_NUMBER_SQL
from snapmart.sources import responses, tables
from snapmart.workspace import new_folder

_EVENTS_SQL = f"""
e AS (
  SELECT event_id, user_id, event_type AS t, date_trunc('second', ts) AS s, ts, props,
         {EVENT_NUMBER_SQL} AS k, 'text ' || props AS words
  FROM events)"""


def _utc(column):
    return times.wall_clock(F.unix_seconds(column)).alias(column)


@registered(
    "flatten_posts",
    f"""
WITH {_EVENTS_SQL}
SELECT 'facebook_' || event_id AS post_id, CASE t WHEN 'view' THEN 'Story' ELSE t END AS post_type,
       CASE t WHEN 'view' THEN '' ELSE words END AS content,
       CASE t WHEN 'signup' THEN 'p' || user_id WHEN 'error' THEN 'c' || user_id
              ELSE CAST(user_id AS VARCHAR) END AS author_id,
       CASE t WHEN 'signup' THEN 'profile ' || user_id WHEN 'error' THEN NULL
              ELSE 'user ' || user_id END AS author_name,
       s AS created_at,
       CASE t WHEN 'click' THEN 'u' || event_id WHEN 'purchase' THEN 't' || event_id
              WHEN 'view' THEN 'a' || event_id ELSE '' END AS media
FROM e""",
)
def flatten_posts(spark, sf_dir):
    records = posts.flatten(bodies.post_responses(spark, sf_dir))
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return posts.to_master_rows(records, as_of).select(
        "post_id",
        F.col("platform_data.post_type").alias("post_type"),
        "content",
        "author_id",
        "author_name",
        _utc("created_at"),
        F.array_join("media_urls", ",").alias("media"),
    )


@registered(
    "flatten_post_metrics",
    f"""
WITH {_EVENTS_SQL}
SELECT 'facebook_' || event_id AS post_id,
       CAST(CASE t WHEN 'view' THEN 0 ELSE k * 1000 + 500 END AS BIGINT) AS likes, k AS comments,
       CAST(CASE t WHEN 'error' THEN 0 ELSE user_id END AS BIGINT) AS shares,
       CAST(CASE WHEN t IN ('click', 'purchase', 'view') THEN k ELSE 0 END AS BIGINT) AS views,
       CASE WHEN k > 0 THEN k END AS reaction_like, event_id AS reaction_love,
       CAST(CASE WHEN k > 0 THEN 2 ELSE 1 END AS BIGINT) AS n_reactions
FROM e""",
)
def flatten_post_metrics(spark, sf_dir):
    records = posts.flatten(bodies.post_responses(spark, sf_dir))
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    breakdown = F.col("reaction_breakdown")
    return posts.to_metrics_rows(records, as_of).select(
        "post_id",
        "likes",
        "comments",
        "shares",
        "views",
        F.try_element_at(breakdown, F.lit("Like")).alias("reaction_like"),
        F.try_element_at(breakdown, F.lit("LOVE")).alias("reaction_love"),
        F.size(breakdown).cast("bigint").alias("n_reactions"),
    )


@registered(
    "flatten_videos",
    f"""
WITH {_EVENTS_SQL}
SELECT CAST(event_id AS VARCHAR) AS video_id, words AS title,
       CASE t WHEN 'view' THEN '' ELSE 'c' || user_id END AS channel_id,
       'channel ' || user_id AS channel_title, CAST(s AS DATE) AS published_at,
       event_id AS views, CAST(CASE t WHEN 'view' THEN 0 ELSE k END AS BIGINT) AS likes,
       CAST(CASE t WHEN 'purchase' THEN NULL ELSE k END AS BIGINT) AS comments,
       CASE t WHEN 'click' THEN t || ', ' || k ELSE '' END AS tags, 'general' AS category
FROM e WHERE t <> 'error'""",
)
def flatten_videos(spark, sf_dir):
    records = videos.classified(videos.flatten(bodies.video_details(spark, sf_dir)))
    return videos.to_master_rows(records, F.lit("2024-02-01").cast("date")).select(
        "video_id",
        "title",
        "channel_id",
        "channel_title",
        "published_at",
        "views",
        "likes",
        "comments",
        "tags",
        "category",
    )


@registered(
    "flatten_shorts",
    f"""
WITH {_EVENTS_SQL}
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE t WHEN 'view' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS author_username,
       CASE t WHEN 'view' THEN NULL ELSE 'nick ' || user_id END AS author_nickname,
       CASE t WHEN 'purchase' THEN ''
              ELSE strftime(s + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END AS create_time,
       k AS likes, user_id AS shares, CAST(CASE t WHEN 'view' THEN 0 ELSE k END AS BIGINT) AS comments,
       event_id AS views, CAST(0 AS BIGINT) AS saved,
       CASE t WHEN 'error' THEN '' ELSE substring(repeat(words, 40), 1, 400) END AS caption,
       t AS category, ts AS crawl_date
FROM e""",
)
def flatten_shorts(spark, sf_dir):
    records = shorts.flatten(bodies.short_responses(spark, sf_dir))
    return shorts.to_history_rows(records, F.col("ts")).drop("ts", "seq", "pos")


@registered(
    "flatten_products",
    f"""
WITH {_EVENTS_SQL},
p AS (
  SELECT *, CASE WHEN t IN ('click', 'signup', 'view') THEN (k * 100000 + 50000) / 100000.0::DOUBLE
                 ELSE 0.0::DOUBLE END AS price FROM e),
b AS (SELECT *, CASE WHEN t IN ('click', 'error') THEN 128.0::DOUBLE ELSE price END AS before FROM p)
SELECT event_id AS itemid, user_id AS shopid, 'a ' || words AS name, price,
       before AS price_before_discount,
       CASE WHEN before > 0 THEN CAST(round_even((before - price) / before * 100, 0) AS BIGINT) || '%'
            ELSE '0%' END AS discount,
       k AS sold_recent, event_id AS sold_total,
       CASE t WHEN 'error' THEN 0.0::DOUBLE ELSE round_even(k / 16.0::DOUBLE, 2) END AS rating_star,
       CAST(CASE WHEN t IN ('view', 'error') THEN 0 ELSE k END AS BIGINT) AS rating_count,
       t = 'click' AS flash_sale,
       CASE t WHEN 'purchase' THEN '1970-01-01' ELSE strftime(s, '%Y-%m-%d') END AS ctime,
       t AS category, ts AS crawl_date
FROM b WHERE event_id <> 0""",
)
def flatten_products(spark, sf_dir):
    records = products.flatten(bodies.product_responses(spark, sf_dir))
    return products.to_history_rows(records, F.col("ts"))


@registered(
    "posts_job",
    f"""
WITH {_EVENTS_SQL},
m AS (
  SELECT 'facebook_' || event_id AS post_id, t AS category, s AS created_at,
         CAST(CASE t WHEN 'view' THEN 0 ELSE k * 1000 + 500 END AS BIGINT) AS likes, k AS comments,
         CAST(CASE t WHEN 'error' THEN 0 ELSE user_id END AS BIGINT) AS shares
  FROM e)
SELECT post_id, created_at, likes, comments, shares, likes + comments + shares AS total_engagement
FROM m WHERE created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR
  AND likes + comments + shares >= 5
ORDER BY total_engagement DESC, post_id LIMIT 20""",
)
def posts_job(spark, sf_dir):
    """Bodies to records to master and snapshots to the trending list.

    The records feed both tables, so they are written once and read twice.
    """
    silver = new_folder(spark, "post-records")
    good = posts.flatten(bodies.post_responses(spark, sf_dir)).where(F.col("problem").isNull())
    good.write.parquet(silver)
    records = spark.read.parquet(silver)
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    master = reduce_batch(posts.to_master_rows(records, as_of), posts.POLICY, ["seq", "pos"])
    snapshots = posts.to_metrics_rows(records, as_of)
    ranked = posts.trending(
        master,
        snapshots,
        "2024-01-31 00:00:00",
        hours=168,
        min_engagement=5,
        ties=("seq", "pos"),
    )
    counts = [f"latest_metrics.{c}" for c in ("likes", "comments", "shares")]
    return ranked.select("post_id", _utc("created_at"), *counts, "total_engagement")


@registered(
    "videos_job",
    f"""
WITH {_EVENTS_SQL},
hits AS (SELECT t AS query, CAST(user_id AS VARCHAR) AS video_id FROM e
         UNION SELECT t, CAST(event_id AS VARCHAR) FROM e)
SELECT h.query, e.event_id AS video_no, e.words AS title, 'channel ' || e.user_id AS channel_title,
       CAST(CASE e.t WHEN 'view' THEN 0 ELSE e.k END AS BIGINT) AS likes, e.t = 'purchase' AS bad
FROM hits h JOIN e ON h.video_id = CAST(e.event_id AS VARCHAR) WHERE e.t <> 'error'""",
)
def videos_job(spark, sf_dir):
    """Search hits, first per query, joined to their details."""
    hits = videos.search_hits(bodies.video_searches(spark, sf_dir))
    named = hits.select(
        F.col("keyword").alias("query"),
        F.regexp_replace("video_id", "^u", "").alias("video_id"),
        "seq",
        "pos",
    )
    details = videos.flatten(bodies.video_details(spark, sf_dir)).select(
        "video_id", "title", "channel_title", "likes", F.col("problem").isNotNull().alias("bad")
    )
    found = hits_with_details(named, details, "video_id", ["seq", "pos"], scope=["query"])
    return found.select(
        "query", F.col("video_id").cast("bigint").alias("video_no"), "title", "channel_title", "likes", "bad"
    )


@registered(
    "products_job",
    f"""
WITH {_EVENTS_SQL},
first_seen AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place,
         max(ts) OVER (PARTITION BY user_id) AS last_seen
  FROM e WHERE event_id <> 0 AND user_id <> 0)
SELECT user_id AS itemid, 'a ' || words AS name, event_id AS sold_total, t AS category,
       ts AS first_day_crawling, last_seen AS last_day_crawling
FROM first_seen WHERE place = 1""",
)
def products_job(spark, sf_dir):
    """Repeated captures of one product per shop: first values, first and last day."""
    records = products.flatten(bodies.product_responses(spark, sf_dir))
    per_shop = records.where(F.col("problem").isNull() & (F.col("shopid") != 0))
    batch = products.to_master_rows(per_shop.withColumn("itemid", F.col("shopid")), F.col("ts"))
    return reduce_batch(batch, products.POLICY, ["seq", "pos"]).select(
        "itemid", "name", "sold_total", "category", "first_day_crawling", "last_day_crawling"
    )


@registered(
    "shorts_job",
    f"""
WITH {_EVENTS_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM e)
SELECT user_id AS user_no, CAST(event_id AS VARCHAR) AS id, t AS category, event_id AS views
FROM placed WHERE place = 1""",
)
def shorts_job(spark, sf_dir):
    """First short video per user over the whole run (first category wins)."""
    records = shorts.flatten(bodies.short_responses(spark, sf_dir))
    by_user = records.withColumn("user_no", F.col("shares"))
    first = keep_first(by_user, ["user_no"], ["seq", "pos"])
    return first.select("user_no", "id", "category", "views")


@registered(
    "flatten_video_snapshots",
    f"""
WITH {_EVENTS_SQL}
SELECT CAST(event_id AS VARCHAR) AS video_id, event_id AS views,
       CAST(CASE t WHEN 'view' THEN 0 ELSE k END AS BIGINT) AS likes, k AS comments,
       CAST(ts AS DATE) AS crawl_date, 'general' AS category, 'youtube' AS platform
FROM e WHERE t NOT IN ('error', 'purchase')""",
)
def flatten_video_snapshots(spark, sf_dir):
    """Snapshot rows of the videos that can be read."""
    records = videos.classified(videos.flatten(bodies.video_details(spark, sf_dir)))
    good = records.where(F.col("problem").isNull())
    return videos.to_snapshot_rows(good, F.col("ts").cast("date")).drop("seq", "pos")


@registered(
    "flatten_short_masters",
    f"""
WITH {_EVENTS_SQL}
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE t WHEN 'view' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS author_username,
       CASE t WHEN 'view' THEN NULL ELSE 'nick ' || user_id END AS author_nickname,
       CASE t WHEN 'purchase' THEN ''
              ELSE strftime(s + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END AS create_time,
       CASE t WHEN 'error' THEN '' ELSE substring(repeat(words, 40), 1, 400) END AS caption,
       t AS category, ts AS first_day_crawling, ts AS last_day_crawling
FROM e""",
)
def flatten_short_masters(spark, sf_dir):
    """Master rows of short videos, without metrics."""
    records = shorts.flatten(bodies.short_responses(spark, sf_dir))
    return shorts.to_master_rows(records, F.col("ts")).drop("seq", "pos")


def _spoiled(captured, kind: str, part: str, bad: str):
    """Responses of one event type with a part of their body replaced."""
    body = F.when(F.col("keyword") == kind, F.regexp_replace("body", part, bad))
    return captured.withColumn("body", body.otherwise(F.col("body")))


def _spoiled_records(spark, sf_dir):
    """Records of all four kinds, each kind with one event type that cannot be read."""
    return (
        (
            "video",
            videos.flatten(
                _spoiled(
                    bodies.video_details(spark, sf_dir), "click", '"viewCount":"', '"viewCount":"1,2'
                )
            ),
        ),
        (
            "short",
            shorts.flatten(
                _spoiled(
                    bodies.short_responses(spark, sf_dir), "signup", '"diggCount":(\\d+)', '"diggCount":"$1K"'
                )
            ),
        ),
        (
            "product",
            products.flatten(
                _spoiled(bodies.product_responses(spark, sf_dir), "view", '"sold":\\d+', '"sold":"many"')
            ),
        ),
        (
            "post",
            posts.flatten(
                _spoiled(
                    bodies.post_responses(spark, sf_dir), "purchase", '"total_count":"', '"total_count":"~'
                )
            ),
        ),
    )


@registered(
    "quarantine_records",
    """
SELECT 'video' AS kind, event_type AS keyword, event_id AS seq, CAST(0 AS BIGINT) AS pos,
       'unreadable count' AS problem FROM events WHERE event_type IN ('click', 'purchase')
UNION ALL SELECT 'short', event_type, event_id, 1, 'unreadable count' FROM events
WHERE event_type = 'signup'
UNION ALL SELECT 'product', event_type, event_id, 0, 'unreadable count' FROM events
WHERE event_type = 'view' AND event_id <> 0
UNION ALL SELECT 'post', event_type, event_id, 1, 'unreadable count' FROM events
WHERE event_type = 'purchase'""",
)
def quarantine_records(spark, sf_dir):
    """Records that cannot be read, from all four flatteners, as their sink keeps them."""
    path = new_folder(spark, "bad-records")
    for kind, records in _spoiled_records(spark, sf_dir):
        tables.append_rows(responses.bad_records(records, kind), path)
    return spark.read.parquet(path)


@registered(
    "counters_with_errors",
    f"""
WITH {_EVENTS_SQL},
good AS (SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n FROM e WHERE t <> 'signup' GROUP BY 1)
SELECT count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS matched,
       CAST(sum(n) AS BIGINT) AS history_inserted,
       (SELECT count(*) FROM e WHERE t = 'signup') AS errors
FROM good""",
)
def counters_with_errors(spark, sf_dir):
    """Counters of a first merge of short videos, of which some cannot be read."""
    records = dict(_spoiled_records(spark, sf_dir))["short"].withColumn(
        "id", F.col("shares").cast("string")
    )
    silver = new_folder(spark, "short-records")
    records.write.parquet(silver)
    records = spark.read.parquet(silver)
    bad = responses.bad_records(records, "short")
    batch = shorts.to_master_rows(records.where(F.col("problem").isNull()), F.col("ts"))
    merged = merge_master(batch.limit(0), batch, shorts.POLICY, ["seq", "pos"])
    return merge_counters(merged, batch, shorts.POLICY, bad)
