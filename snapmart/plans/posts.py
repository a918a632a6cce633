"""Posts: from search responses to master, metrics history and trending list."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions import numbers, texts, times
from snapmart.functions.variants import (
    filled,
    is_text,
    shaped_at,
    truthy,
    truthy_long,
    truthy_node,
    truthy_text,
)
from snapmart.operators import filters
from snapmart.operators.latest import LATEST, attach_latest_selective
from snapmart.operators.merge import MergePolicy
from snapmart.operators.ranking import top
from snapmart.sources.responses import explode_records

# FIXED VALUES: where the results of a search are and how one is built.
RESULT_PATHS = ("$.data.serpResponse.results.edges", "$.data.results.edges")
_PERSON = "struct<id: string, name: string>"
_MEDIA = """
    struct<__typename: string, id: string, url: string,
           thumbnailImage: struct<uri: string>,
           preferred_story_attachment_image: struct<uri: string>>"""
_FEEDBACK = """
    struct<
      i18n_reaction_count: variant,
      top_reactions: struct<edges: array<struct<
        reaction_count: variant, i18n_reaction_count: variant,
        node: struct<localized_name: string, reaction_type: string>>>>,
      share_count: struct<count: variant>,
      comments_count_summary_renderer: struct<feedback: struct<
        comment_rendering_instance: struct<comments: struct<total_count: variant>>>>>"""
_STORY = f"""
    struct<
      id: string,
      __typename: string,
      message: struct<text: string>,
      attachments: array<struct<styles: struct<attachment: struct<url: string, media: variant>>>>,
      comet_sections: struct<
        content: struct<story: struct<
          actors: array<{_PERSON}>,
          comet_sections: struct<message: struct<story: struct<message: struct<text: string>>>>>>,
        timestamp: struct<story: struct<creation_time: variant>>,
        context_layout: struct<story: struct<comet_sections: struct<
          actor_photo: struct<story: struct<actors: array<{_PERSON}>>>,
          metadata: array<struct<story: struct<creation_time: variant>>>>>>,
        feedback: struct<story: struct<story_ufi_container: struct<story: struct<
          feedback_context: struct<feedback_target_with_context: struct<
            owning_profile: {_PERSON},
            comet_ufi_summary_and_actions_renderer: struct<feedback: {_FEEDBACK}>>>>>>>>>"""
RESULT_SHAPE = (
    f"struct<rendering_strategy: struct<view_model: struct<click_model: struct<story: {_STORY}>>>>"
)
STORY = "record.rendering_strategy.view_model.click_model.story"
CONTENT = "story.comet_sections.content.story"
CONTEXT = "story.comet_sections.context_layout.story.comet_sections"
TARGET = (
    "story.comet_sections.feedback.story.story_ufi_container.story"
    ".feedback_context.feedback_target_with_context"
)
FEEDBACK = f"{TARGET}.comet_ufi_summary_and_actions_renderer.feedback"
COMMENT_TOTAL = (
    f"{FEEDBACK}.comments_count_summary_renderer.feedback"
    ".comment_rendering_instance.comments.total_count"
)

POLICY = MergePolicy(
    key="post_id",
    insert_only=(
        "author_name",
        "author_id",
        "content",
        "media_urls",
        "created_at",
        "category",
        "platform",
        "platform_data",
    ),
    overwrite=("scraped_at", "crawl_session_id"),
    add_to_set={"matched_keywords": "keyword"},
)


def _first(path: str) -> Column:
    return F.get(F.col(path), F.lit(0))


def _author() -> Column:
    """Struct (id, name) of the author, looked for in three places."""
    places = [
        _first(f"{CONTENT}.actors"),
        F.col(f"{TARGET}.owning_profile"),
        _first(f"{CONTEXT}.actor_photo.story.actors"),
    ]
    ids = [filled(p["id"]) for p in places]

    # Without any id the last place that exists decides about the name.
    last = F.when(places[2].isNotNull(), places[2]["name"]).when(
        places[1].isNotNull(), places[1]["name"]
    )
    name = F.coalesce(
        filled(last), filled(places[0]["name"]), F.lit(settings.UNKNOWN_AUTHOR)
    )
    number = texts.surrogate_number(name, settings.SURROGATE_MODULUS)
    nameless = F.struct(
        F.concat(F.lit(settings.AUTHOR_ID_PREFIX), number.cast("string")).alias("id"),
        name.alias("name"),
    )
    found = [
        F.when(i.isNotNull(), F.struct(i.alias("id"), p["name"].alias("name")))
        for i, p in zip(ids, places, strict=True)
    ]
    return F.coalesce(*found, nameless)


def _reaction_entries() -> Column:
    """Array of (name, count) in order; a count is NULL when it is unreadable."""

    def named(name: Column, shown: Column) -> Column:
        return F.struct(name.alias("name"), numbers.tidy_count(shown).alias("shown"))

    def of_edge(edge: Column) -> Column:
        node = edge["node"]
        return named(
            F.coalesce(filled(node["localized_name"]), node["reaction_type"]),
            F.coalesce(
                truthy_text(edge["reaction_count"]), truthy_text(edge["i18n_reaction_count"])
            ),
        )

    total = named(F.lit("total"), truthy_text(F.col(f"{FEEDBACK}.i18n_reaction_count")))
    edges = F.transform(F.col(f"{FEEDBACK}.top_reactions.edges"), of_edge)
    none = F.array().cast("array<struct<name:string,shown:string>>")
    spelled = F.filter(
        F.concat(F.array(total), F.coalesce(edges, none)),
        lambda e: (e["name"] != "") & e["shown"].isNotNull(),
    )
    return F.transform(
        spelled,
        lambda e: F.struct(
            e["name"].alias("name"), numbers.count_of_tidy(e["shown"]).alias("count")
        ),
    )


def _reaction_map(entries: Column) -> Column:
    """Map name to count; a name that comes again replaces the earlier one."""

    def is_last(e: Column, i: Column) -> Column:
        later = F.slice(entries, i + F.lit(2), F.size(entries))
        return ~F.exists(later, lambda other: other["name"] == e["name"])

    distinct = F.size(F.array_distinct(entries["name"])) == F.size(entries)
    return F.map_from_entries(F.when(distinct, entries).otherwise(F.filter(entries, is_last)))


def _attachments() -> Column:
    """Array of (type, id, url, thumbnail) of the attachments that have media."""

    def opened(item: Column) -> Column:
        holder = item["styles"]["attachment"]
        both = F.struct(
            filled(holder["url"]).alias("url"),
            shaped_at(holder["media"], "$", _MEDIA).alias("media"),
        )
        return F.when(truthy_node(holder["media"]), both)

    def one(item: Column) -> Column:
        media = item["media"]
        return F.struct(
            media["__typename"].alias("type"),
            media["id"].alias("id"),
            F.coalesce(item["url"], media["url"]).alias("url"),
            F.coalesce(
                filled(media["thumbnailImage"]["uri"]),
                media["preferred_story_attachment_image"]["uri"],
            ).alias("thumbnail"),
        )

    found = F.filter(
        F.transform(F.transform(F.col("story.attachments"), opened), one),
        lambda a: filled(a["url"]).isNotNull() | filled(a["id"]).isNotNull(),
    )
    none = F.array().cast("array<struct<type:string,id:string,url:string,thumbnail:string>>")
    return F.coalesce(found, none)


def flatten(responses: DataFrame) -> DataFrame:
    """Post records of search responses, with ``problem`` set on unreadable ones.

    Output: the response columns (``keyword``, ``seq``, ...), ``pos`` and the
    record's fields.  Records without id, text and attachments are dropped.
    """
    edges = explode_records(responses, RESULT_SHAPE, *RESULT_PATHS)
    carried = [c for c in edges.columns if c != "record"]
    published = F.col("story.comet_sections.timestamp.story.creation_time")
    published_too = F.get(F.col(f"{CONTEXT}.metadata"), F.lit(1))["story"]["creation_time"]
    publish = F.when(truthy(published), published).otherwise(published_too)
    text = F.coalesce(
        filled(F.col(f"{CONTENT}.comet_sections.message.story.message.text")),
        filled(F.col("story.message.text")),
        F.lit(""),
    )
    views = F.try_variant_get(
        _first("story.attachments")["styles"]["attachment"]["media"],
        "$.video_view_count",
        "variant",
    )
    # A generator of one row: the filter on the attachments stays above it, so
    # they are typed once.
    stories = edges.select(*carried, F.col(STORY).alias("story")).select(
        *carried, "story", F.explode(F.array(_attachments())).alias("attachments")
    )
    shaped = stories.select(
        *carried,
        filled(F.col("story.id")).alias("id"),
        F.coalesce(F.col("story.__typename"), F.lit("Story")).alias("type"),
        text.alias("text"),
        _author().alias("author"),
        # Text is no valid publish time.
        F.when(~is_text(publish), publish.try_cast("bigint")).alias("publish_time"),
        truthy_long(F.col(COMMENT_TOTAL)).alias("comment_count"),
        truthy_long(F.col(f"{FEEDBACK}.share_count.count")).alias("share_count"),
        truthy_long(views).alias("view_count"),
        _reaction_entries().alias("entries"),
        "attachments",
    )
    kept = filters.with_content(
        shaped.where(F.col("id").isNotNull()), "text", "attachments"
    )
    unreadable = (
        F.col("comment_count").isNull()
        | F.col("share_count").isNull()
        | F.col("view_count").isNull()
        | F.exists("entries", lambda e: e["count"].isNull())
    )
    return kept.select(
        *carried,
        "id",
        "type",
        "text",
        F.col("author.id").alias("author_id"),
        F.col("author.name").alias("owner"),
        F.coalesce("publish_time", F.lit(0)).alias("publish_time"),
        "comment_count",
        "share_count",
        "view_count",
        _reaction_map(F.col("entries")).alias("reactions"),
        "attachments",
        F.lit(settings.EXTRACTION_METHOD).alias("extraction_method"),
        F.when(unreadable, "unreadable count").alias("problem"),
    )


def _session_id(moment: Column) -> Column:
    return F.date_format(moment, times.MINUTE)


def to_master_rows(
    records: DataFrame, as_of: Column, categories=settings.POST_CATEGORIES
) -> DataFrame:
    """Batch rows for the ``posts`` master (see ``POLICY``)."""
    platform = settings.POST_PLATFORM
    prepared = records.select(
        "*", F.lower("text").alias("_text"), F.lower("keyword").alias("_keyword")
    )
    urls = F.transform(
        F.col("attachments"),
        lambda a: F.coalesce(F.nullif(a["url"], F.lit("")), F.nullif(a["thumbnail"], F.lit(""))),
    )
    guest = F.concat(
        F.lit(f"{platform}_user_"),
        texts.surrogate_number(F.col("owner"), settings.SURROGATE_MODULUS).cast("string"),
    )
    return prepared.select(
        *(c for c in ("seq", "pos") if c in records.columns),
        F.concat(F.lit(f"{platform}_"), F.col("id")).alias("post_id"),
        F.col("owner").alias("author_name"),
        F.coalesce(F.nullif(F.col("author_id"), F.lit("")), guest).alias("author_id"),
        F.col("text").alias("content"),
        F.filter(urls, lambda u: u.isNotNull()).alias("media_urls"),
        times.instant(F.col("publish_time")).alias("created_at"),
        texts.category_of(
            [F.col("_keyword"), F.col("_text")], categories, settings.DEFAULT_CATEGORY
        ).alias("category"),
        F.lit(platform).alias("platform"),
        F.struct(
            F.col("id").alias("native_post_id"),
            F.col("author_id").alias("native_author_id"),
            F.col("type").alias("post_type"),
            F.col("extraction_method").alias("extraction_method"),
        ).alias("platform_data"),
        as_of.alias("scraped_at"),
        _session_id(as_of).alias("crawl_session_id"),
        "keyword",
    )


def to_metrics_rows(records: DataFrame, as_of: Column) -> DataFrame:
    """Snapshot rows for ``metrics_snapshot``."""
    reactions = F.col("reactions")
    return records.select(
        *(c for c in ("seq", "pos") if c in records.columns),
        F.concat(F.lit(f"{settings.POST_PLATFORM}_"), F.col("id")).alias("post_id"),
        F.coalesce(F.try_element_at(reactions, F.lit("total")), F.lit(0)).alias("likes"),
        F.col("comment_count").alias("comments"),
        F.col("share_count").alias("shares"),
        F.col("view_count").alias("views"),
        F.map_filter(reactions, lambda name, _: name != "total").alias("reaction_breakdown"),
        as_of.alias("snapshot_time"),
        _session_id(as_of).alias("crawl_session_id"),
    )


def trending(
    posts: DataFrame,
    metrics: DataFrame,
    as_of: str | datetime,
    category: str | None = None,
    hours: float = 24,
    min_engagement: int = 10,
    ties: tuple[str, ...] = (),
    limit: int = settings.TRENDING_POSTS_LIMIT,
) -> DataFrame:
    """Recent posts by likes + comments + shares of their newest snapshot.

    ``ties`` orders snapshots of one post taken at the same time.  Output: all
    post columns, the snapshot as ``latest_metrics`` and ``total_engagement``.
    """
    recent = filters.in_category(
        posts.where(times.since(posts, "created_at", as_of, hours)), category
    )
    latest = attach_latest_selective(recent, metrics, "post_id", "snapshot_time", ties)
    parts = [F.col(f"{LATEST}.{c}") for c in ("likes", "comments", "shares")]
    scored = latest.withColumn("total_engagement", numbers.added(*parts))
    enough = filters.at_least(scored, "total_engagement", min_engagement)
    return top(enough, "total_engagement", ["post_id"], limit)


__all__ = [
    "POLICY",
    "flatten",
    "to_master_rows",
    "to_metrics_rows",
    "trending",
]
