"""Responses as the four sites would send them, spelled from the given tables.

One response per event; the event type decides which of the alternative places
and notations a record uses, so every branch of the flatteners is taken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions import times
from snapmart.registry import views


# Spelling and decoding a body cost far more than moving its event.
TASKS_PER_CORE = 3


def nest(path: str, value: Column) -> Column:
    """{'a': {'b': value}} for 'a.b'."""
    return reduce(lambda inner, name: F.struct(inner.alias(name)), reversed(path.split(".")), value)


def kind_is(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def only(test: Column, value: Column) -> Column:
    """The value, or a missing key."""
    return F.when(test, value)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, dealt out: their file may have few row groups, which Spark does not split."""
    tasks = max(
        TASKS_PER_CORE * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    return views.load(spark, sf_dir, "events").repartition(tasks).select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        views.event_number().alias("k"),
        times.epoch_seconds(F.col("ts")).alias("epoch"),
        F.col("event_id").cast("string").alias("id_text"),
        F.col("user_id").cast("string").alias("user_text"),
        F.concat(F.lit("text "), F.col("props")).alias("words"),
    )


def _responses(shaped: DataFrame, envelope: Column, guard: Column | None = None) -> DataFrame:
    body = F.to_json(envelope)
    return shaped.select(
        F.col("event_type").alias("keyword"),
        F.col("event_id").alias("seq"),
        "ts",
        (body if guard is None else F.concat(guard, body)).alias("body"),
    )


def post_story() -> Column:
    """A story whose fields sit in different places per event type."""
    k_text = F.col("k").cast("string")
    actor = F.struct(
        only(kind_is("click", "view", "purchase"), F.col("user_text")).alias("id"),
        only(~kind_is("error"), F.concat(F.lit("user "), F.col("user_text"))).alias("name"),
    )
    profile = only(
        kind_is("signup"),
        F.struct(
            F.concat(F.lit("p"), F.col("user_text")).alias("id"),
            F.concat(F.lit("profile "), F.col("user_text")).alias("name"),
        ),
    )
    context_actor = only(
        kind_is("error", "signup"),
        F.struct(F.concat(F.lit("c"), F.col("user_text")).alias("id")),
    )
    message = only(kind_is("click", "purchase", "signup"), F.col("words"))
    reactions = F.struct(
        only(~kind_is("view"), F.concat(k_text, F.lit(".5K"))).alias("i18n_reaction_count"),
        F.struct(
            F.array(
                F.struct(
                    F.col("k").alias("reaction_count"),
                    F.lit(None).cast("string").alias("i18n_reaction_count"),
                    F.struct(
                        F.lit("Like").alias("localized_name"), F.lit("LIKE").alias("reaction_type")
                    ).alias("node"),
                ),
                F.struct(
                    F.lit(None).cast("bigint").alias("reaction_count"),
                    F.format_number("event_id", 0).alias("i18n_reaction_count"),
                    F.struct(
                        F.lit(None).cast("string").alias("localized_name"),
                        F.lit("LOVE").alias("reaction_type"),
                    ).alias("node"),
                ),
                F.struct(
                    F.lit(None).cast("bigint").alias("reaction_count"),
                    F.lit(None).cast("string").alias("i18n_reaction_count"),
                    F.struct(
                        F.lit("Haha").alias("localized_name"), F.lit("HAHA").alias("reaction_type")
                    ).alias("node"),
                ),
            ).alias("edges")
        ).alias("top_reactions"),
        nest("count", only(~kind_is("error"), F.col("user_id"))).alias("share_count"),
        nest(
            "feedback.comment_rendering_instance.comments.total_count", k_text
        ).alias("comments_count_summary_renderer"),
    )
    target = F.struct(
        profile.alias("owning_profile"),
        nest("feedback", reactions).alias("comet_ufi_summary_and_actions_renderer"),
    )
    media = only(
        kind_is("click", "purchase", "view"),
        F.struct(
            F.lit("Video").alias("__typename"),
            F.concat(F.lit("m"), F.col("id_text")).alias("id"),
            only(kind_is("click"), F.concat(F.lit("u"), F.col("id_text"))).alias("url"),
            F.col("k").alias("video_view_count"),
            nest("uri", only(kind_is("purchase"), F.concat(F.lit("t"), F.col("id_text")))).alias(
                "thumbnailImage"
            ),
        ),
    )
    attachment = F.struct(
        F.struct(
            F.struct(
                only(kind_is("view"), F.concat(F.lit("a"), F.col("id_text"))).alias("url"),
                media.alias("media"),
            ).alias("attachment")
        ).alias("styles")
    )
    return F.struct(
        F.col("id_text").alias("id"),
        only(~kind_is("view"), F.col("event_type")).alias("__typename"),
        nest("text", only(kind_is("error"), F.col("words"))).alias("message"),
        F.array(attachment).alias("attachments"),
        F.struct(
            F.struct(
                F.struct(
                    F.array(actor).alias("actors"),
                    nest("message.story.message.text", message).alias("comet_sections"),
                ).alias("story")
            ).alias("content"),
            nest("story.creation_time", only(~kind_is("signup"), F.col("epoch"))).alias(
                "timestamp"
            ),
            nest(
                "story.comet_sections",
                F.struct(
                    nest("story.actors", F.array(context_actor)).alias("actor_photo"),
                    F.array(
                        nest("story.creation_time", F.lit(None).cast("bigint")),
                        nest("story.creation_time", only(kind_is("signup"), F.col("epoch"))),
                    ).alias("metadata"),
                ),
            ).alias("context_layout"),
            nest(
                "story.story_ufi_container.story.feedback_context.feedback_target_with_context",
                target,
            ).alias("feedback"),
        ).alias("comet_sections"),
    )


def post_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post searches: two result places, guards, an edge without a story."""
    edge = nest("rendering_strategy.view_model.click_model.story", F.col("story"))
    bare = nest(
        "rendering_strategy.view_model.click_model.story",
        F.struct(F.lit(None).cast("string").alias("none")),
    )
    shaped = events(spark, sf_dir).withColumn("story", post_story())
    # The edges differ in shape, so they are put into the list as text.
    result = F.concat(
        F.lit('{"edges":['), F.to_json(bare), F.lit(","), F.to_json(edge), F.lit("]}")
    )
    search = F.concat(F.lit('{"data":{"serpResponse":{"results":'), result, F.lit("}}}"))
    other = F.concat(
        F.lit('{"data":{"serpResponse":{"results":{"edges":[]}},"results":'), result, F.lit("}}")
    )
    guard = F.when(kind_is("click"), "for (;;);").when(kind_is("view"), "junk").otherwise("")
    body = F.concat(guard, F.when(kind_is("purchase", "view"), other).otherwise(search))
    return shaped.select(
        F.col("event_type").alias("keyword"), F.col("event_id").alias("seq"), "ts", body.alias("body")
    )


def video_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video details: counts as text, numbers or missing; one excluded channel."""
    k_text = F.col("k").cast("string")
    channel = F.when(kind_is("error"), F.lit(" Yến Nồi Cơm Điện Official ")).otherwise(
        F.concat(F.lit("channel "), F.col("user_text"))
    )
    item = F.struct(
        F.col("id_text").alias("id"),
        F.struct(
            F.col("words").alias("title"),
            only(~kind_is("view"), F.concat(F.lit("c"), F.col("user_text"))).alias("channelId"),
            channel.alias("channelTitle"),
            F.concat(times.day_text(F.col("epoch")), F.lit("T10:00:00Z")).alias("publishedAt"),
            only(kind_is("click"), F.array(F.col("event_type"), k_text)).alias("tags"),
        ).alias("snippet"),
        F.struct(
            F.col("id_text").alias("viewCount"),
            only(~kind_is("view"), k_text).alias("likeCount"),
            F.when(kind_is("purchase"), "many").otherwise(k_text).alias("commentCount"),
        ).alias("statistics"),
    )
    return _responses(events(spark, sf_dir), F.struct(F.array(item).alias("items")))


def video_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video searches: each names the user's video and the event's video."""
    shaped = events(spark, sf_dir)

    def hit(video: Column) -> Column:
        return F.struct(
            nest("videoId", video).alias("id"),
            nest("channelTitle", F.concat(F.lit("channel "), F.col("user_text"))).alias("snippet"),
        )

    items = F.array(hit(F.concat(F.lit("u"), F.col("user_text"))), hit(F.col("id_text")))
    return _responses(shaped, F.struct(items.alias("items")))


def short_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short videos: wrapped or bare, two places for id and counts, a stray element."""
    counts = F.struct(
        F.col("k").alias("diggCount"),
        F.col("user_id").alias("shareCount"),
        only(~kind_is("view"), F.col("k").cast("string")).alias("commentCount"),
        F.col("id_text").alias("playCount"),
    )
    long_text = F.repeat(F.col("words"), 40)
    video = F.struct(
        only(~kind_is("signup"), F.col("id_text")).alias("id"),
        nest("id", only(kind_is("signup"), F.col("id_text"))).alias("video"),
        only(~kind_is("error"), long_text).alias("desc"),
        only(~kind_is("purchase"), F.col("epoch").cast("string")).alias("createTime"),
        only(
            ~kind_is("view"),
            F.struct(
                F.col("user_text").alias("uniqueId"),
                F.concat(F.lit("nick "), F.col("user_text")).alias("nickname"),
            ),
        ).alias("author"),
        only(kind_is("click", "view", "error"), counts).alias("stats"),
        only(kind_is("signup", "purchase"), counts).alias("statsV2"),
    )
    element = F.when(
        kind_is("click", "signup"), F.to_json(F.struct(video.alias("item")))
    ).otherwise(F.to_json(video))
    body = F.concat(F.lit('{"data":["stray",'), element, F.lit("]}"))
    return events(spark, sf_dir).select(
        F.col("event_type").alias("keyword"), F.col("event_id").alias("seq"), "ts", body.alias("body")
    )


def product_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products: price in two places or missing, ratings present, empty or missing."""
    units = F.col("k") * 100000 + 50000
    item = F.struct(
        F.col("event_id").alias("itemid"),
        F.col("user_id").alias("shopid"),
        F.concat(F.lit(" a  \t"), F.col("words"), F.lit("\n")).alias("name"),
        only(kind_is("click", "signup"), units).alias("price"),
        only(kind_is("view"), units).alias("price_min"),
        only(kind_is("click", "error"), F.lit(12800000)).alias("price_before_discount"),
        F.col("k").alias("sold"),
        F.col("event_id").alias("historical_sold"),
        F.struct(
            only(~kind_is("error"), F.col("k") / 16).alias("rating_star"),
            F.when(kind_is("view"), F.array().cast("array<bigint>"))
            .when(~kind_is("error"), F.array("k", "user_id"))
            .alias("rating_count"),
        ).alias("item_rating"),
        only(kind_is("click"), F.lit(True)).alias("flash_sale"),
        only(~kind_is("purchase"), F.col("epoch")).alias("ctime"),
    )
    element = F.struct(item.alias("item_basic"))
    return _responses(events(spark, sf_dir), F.struct(F.array(element).alias("items")))
