"""Videos: search hits, details, master, snapshots and trending list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions import texts, times
from snapmart.functions.variants import count_or_zero, filled
from snapmart.operators import filters
from snapmart.operators.merge import MergePolicy
from snapmart.operators.ranking import top
from snapmart.sources.responses import explode_records

# FIXED VALUES: the parts of a search hit and of a detail record that are read.
ITEMS_PATH = "$.items"
HIT_SHAPE = "struct<id: struct<videoId: string>, snippet: struct<channelTitle: string>>"
DETAIL_SHAPE = """
    struct<
      id: string,
      snippet: struct<title: string, channelId: string, channelTitle: string,
                      publishedAt: string, tags: array<string>>,
      statistics: struct<viewCount: variant, likeCount: variant, commentCount: variant>>"""

POLICY = MergePolicy(
    key="video_id",
    insert_only=(
        "title",
        "channel_id",
        "channel_title",
        "published_at",
        "category",
        "platform",
        "tags",
        "first_crawl_date",
    ),
    overwrite=("views", "likes", "comments", "last_crawl_date"),
)


def search_hits(responses: DataFrame, excluded=settings.EXCLUDED_CHANNELS) -> DataFrame:
    """Video ids of search responses, without excluded channels."""
    items = explode_records(responses, HIT_SHAPE, ITEMS_PATH)
    carried = [c for c in items.columns if c != "record"]
    hits = items.select(
        *carried,
        filled(F.col("record.id.videoId")).alias("video_id"),
        F.col("record.snippet.channelTitle").alias("channel_title"),
    ).where(F.col("video_id").isNotNull())
    return filters.exclude_channels(hits, "channel_title", excluded)


def flatten(responses: DataFrame, excluded=settings.EXCLUDED_CHANNELS) -> DataFrame:
    """Video records of detail responses; ``problem`` marks incomplete ones."""
    items = explode_records(responses, DETAIL_SHAPE, ITEMS_PATH)
    carried = [c for c in items.columns if c != "record"]
    snippet, counts = F.col("record.snippet"), F.col("record.statistics")
    shaped = items.select(
        *carried,
        filled(F.col("record.id")).alias("video_id"),
        snippet["title"].alias("title"),
        F.coalesce(snippet["channelId"], F.lit("")).alias("channel_id"),
        F.coalesce(snippet["channelTitle"], F.lit("")).alias("channel_title"),
        times.iso_day(snippet["publishedAt"]).alias("published_at"),
        count_or_zero(counts["viewCount"]).alias("views"),
        count_or_zero(counts["likeCount"]).alias("likes"),
        count_or_zero(counts["commentCount"]).alias("comments"),
        F.coalesce(F.array_join(snippet["tags"], ", "), F.lit("")).alias("tags"),
    )
    kept = filters.exclude_channels(
        shaped.where(F.col("video_id").isNotNull()), "channel_title", excluded
    )
    incomplete = F.col("title").isNull() | F.col("published_at").isNull()
    unreadable = F.col("views").isNull() | F.col("likes").isNull() | F.col("comments").isNull()
    return kept.withColumn(
        "problem", F.when(incomplete, "no title or date").when(unreadable, "unreadable count")
    )


def classified(
    records: DataFrame, query: str = "keyword", categories=settings.VIDEO_CATEGORIES
) -> DataFrame:
    """Records with the category found in title, tags and search query."""
    joined = F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("title", "tags", query)))
    return (
        records.withColumn("_text", F.lower(joined))
        .withColumn(
            "category",
            texts.category_of([F.col("_text")], categories, settings.DEFAULT_CATEGORY),
        )
        .drop("_text")
    )


def to_master_rows(records: DataFrame, crawl_date: Column) -> DataFrame:
    """Batch rows for the ``videos`` master from classified records."""
    return records.select(
        *(c for c in ("seq", "pos") if c in records.columns),
        "video_id",
        "title",
        "channel_id",
        "channel_title",
        F.to_date("published_at").alias("published_at"),
        "category",
        F.lit(settings.VIDEO_PLATFORM).alias("platform"),
        "tags",
        "views",
        "likes",
        "comments",
        crawl_date.alias("first_crawl_date"),
        crawl_date.alias("last_crawl_date"),
    )


def to_snapshot_rows(records: DataFrame, crawl_date: Column) -> DataFrame:
    """Snapshot rows from classified records."""
    return records.select(
        *(c for c in ("seq", "pos") if c in records.columns),
        "video_id",
        "views",
        "likes",
        "comments",
        crawl_date.alias("crawl_date"),
        "category",
        F.lit(settings.VIDEO_PLATFORM).alias("platform"),
    )


OUTPUT = (
    "video_id",
    "title",
    "channel_title",
    "category",
    "views",
    "likes",
    "comments",
    "published_at",
)


def trending(
    master: DataFrame, category: str | None = None, min_views: int = 1000, limit: int = 20
) -> DataFrame:
    """Videos of the master by views."""
    chosen = filters.in_category(filters.at_least(master, "views", min_views), category)
    return top(chosen, "views", ["video_id"], limit).select(*OUTPUT)
