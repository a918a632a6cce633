"""Routing, decoding, envelopes, quarantine, response logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions.variants import decode_tolerant, long_at, text_at
from snapmart.plans import posts, products, shorts, videos
from snapmart.registry import bodies, registered, views
from snapmart.registry.views import EVENT_NUMBER_SQL
from snapmart.sources import responses
from snapmart.workspace import new_folder


@registered(
    "route_responses",
    """
SELECT page_id, length(url) > 0 AND url LIKE 'https%' AS has_guard,
       CAST(length(html) AS BIGINT) AS n_html
FROM pages
WHERE contains(url, 'example.com') AND url NOT LIKE '%/fr/%' AND url NOT LIKE '%/de/%'""",
)
def route_responses(spark, sf_dir):
    node = F.struct(
        F.when(F.contains("url", F.lit("/de/")), F.lit(None).cast("string"))
        .otherwise(F.col("html"))
        .alias("serpResponse")
    )
    good = F.to_json(F.struct(node.alias("data")))
    secure = F.startswith("url", F.lit("https"))
    body = (
        F.when(F.contains("url", F.lit("/fr/")), F.col("html"))
        .when(secure, F.concat(F.lit(settings.JSON_GUARDS[0]), good))
        .otherwise(good)
    )
    captured = views.load(spark, sf_dir, "pages").select(
        "page_id",
        secure.alias("has_guard"),
        F.replace("url", F.lit("example.com"), F.lit("example.com/api/graphql")).alias("url"),
        body.alias("body"),
    )
    routed = responses.route_posts(captured)
    decoded = F.try_parse_json("body")
    return routed.select(
        "page_id",
        "has_guard",
        F.length(text_at(decoded, "$.data.serpResponse")).cast("bigint").alias("n_html"),
    )


@registered(
    "route_by_url",
    """
SELECT page_id, url FROM pages WHERE contains(url, '.example.org/en/')""",
)
def route_by_url(spark, sf_dir):
    pages = views.load(spark, sf_dir, "pages")
    return responses.route_by_url(pages, ".example.org/en/").select("page_id", "url")


@registered(
    "decode_tolerant",
    f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN {EVENT_NUMBER_SQL} END AS k FROM events""",
)
def decode_bodies(spark, sf_dir):
    kind = F.col("event_type")
    body = (
        F.when(kind == "click", F.concat(F.lit("for (;;);"), "props"))
        .when(kind == "view", F.concat(F.lit("while(1);"), "props"))
        .when(kind == "signup", F.concat(F.lit("while(true);"), "props"))
        .when(kind == "purchase", F.concat(F.lit("junk"), "props"))
        .otherwise(F.expr("left(props, length(props) - 1)"))
    )
    captured = views.load(spark, sf_dir, "events").select("event_id", body.alias("body"))
    decoded = captured.select("event_id", decode_tolerant(F.col("body")).alias("doc"))
    return decoded.select("event_id", long_at(F.col("doc"), "$.k").alias("k"))


@registered(
    "quarantine",
    """
SELECT doc_id, text AS body, 'unreadable' AS reason FROM documents WHERE lang <> 'en'""",
)
def quarantine(spark, sf_dir):
    body = F.when(F.col("lang") == "en", F.to_json(F.struct("text"))).otherwise(F.col("text"))
    captured = views.load(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    return responses.undecodable(captured)


@registered(
    "explode_envelopes",
    """
SELECT 'post' AS kind, event_id AS seq, CAST(1 AS BIGINT) AS pos, CAST(event_id AS VARCHAR) AS id
FROM events
UNION ALL SELECT 'hit', event_id, 0, 'u' || user_id FROM events
UNION ALL SELECT 'hit', event_id, 1, CAST(event_id AS VARCHAR) FROM events
UNION ALL SELECT 'short', event_id, 1, CAST(event_id AS VARCHAR) FROM events
UNION ALL SELECT 'product', event_id, 0, CAST(event_id AS VARCHAR) FROM events""",
)
def explode_envelopes(spark, sf_dir):
    def listed(kind, exploded, identity):
        return exploded.select(
            F.lit(kind).alias("kind"), "seq", F.col("pos").cast("bigint"), identity.alias("id")
        ).where(F.col("id").isNotNull())

    def cut(frame, *places):
        return responses.explode_records(frame, "variant", *places)

    record = F.col("record")
    story = "$.rendering_strategy.view_model.click_model.story.id"
    post = cut(bodies.post_responses(spark, sf_dir), *posts.RESULT_PATHS)
    short = cut(bodies.short_responses(spark, sf_dir), shorts.DATA_PATH)
    product = cut(bodies.product_responses(spark, sf_dir), products.ITEMS_PATH)
    hits = videos.search_hits(bodies.video_searches(spark, sf_dir))
    short_places = ("$.item.id", "$.item.video.id", "$.id", "$.video.id")
    return (
        listed("post", post, text_at(record, story))
        .unionByName(listed("hit", hits, F.col("video_id")))
        .unionByName(listed("short", short, F.coalesce(*(text_at(record, p) for p in short_places))))
        .unionByName(listed("product", product, text_at(record, "$.item_basic.itemid")))
    )


@registered(
    "raw_log",
    """
SELECT replace(event_type, 'up', ' up') AS keyword, event_id AS seq, props AS body FROM events""",
)
def raw_log(spark, sf_dir):
    root = new_folder(spark, "raw-log")
    section = F.concat(
        F.lit("=== RESPONSE "), F.col("event_id").cast("string"), F.lit(" ===\n"), "props",
        F.lit("\n"),
    )
    keyword = F.replace("event_type", F.lit("up"), F.lit("_up"))
    log = F.concat(F.lit("graphql_"), keyword, F.lit(".json"))
    events = views.load(spark, sf_dir, "events")
    events.select(log.alias("log"), section.alias("value")).write.partitionBy("log").text(root)
    return responses.read_response_log(spark, f"{root}/*")
