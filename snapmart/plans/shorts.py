"""Short videos: flattening, master, history and trending list."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions import times
from snapmart.functions.variants import count_or_zero, filled, shaped_at, truthy_node
from snapmart.operators import filters
from snapmart.operators.dedup import first_rows
from snapmart.operators.merge import MergePolicy
from snapmart.operators.ranking import top
from snapmart.sources.responses import explode_records

# FIXED VALUES: the parts of a search element that are read.
DATA_PATH = "$.data"
_COUNTS = """
    struct<diggCount: variant, shareCount: variant, commentCount: variant,
           playCount: variant, collectCount: variant>"""
_VIDEO = """
    struct<id: string, video: struct<id: string>, desc: string, createTime: bigint,
           author: struct<uniqueId: string, nickname: string>,
           stats: variant, statsV2: variant>"""

COUNTS = ("likes", "shares", "comments", "views", "saved")

POLICY = MergePolicy(
    key="id",
    insert_only=(
        "author_username",
        "author_nickname",
        "create_time",
        "caption",
        "category",
        "first_day_crawling",
    ),
    overwrite=("last_day_crawling",),
)


def flatten(responses: DataFrame) -> DataFrame:
    """Short-video records; ``problem`` marks those with an unreadable count.

    The category is the keyword of the request.

    Elements that are no objects are skipped; an element's ``item``, if it has
    one, takes the element's place.
    """

    def opened(element: Column) -> Column:
        wrapped = F.try_variant_get(element, "$.item", "variant")
        return shaped_at(F.coalesce(wrapped, element), "$", _VIDEO)

    items = explode_records(responses, "variant", DATA_PATH, each=opened)
    carried = [c for c in items.columns if c not in ("record", "keyword")]
    first = F.col("video.stats")
    counts = F.when(truthy_node(first), first).otherwise(F.col("video.statsV2"))
    counted = items.withColumnRenamed("record", "video").select(
        *carried, "keyword", "video", shaped_at(counts, "$", _COUNTS).alias("counts")
    )

    def count(name: str) -> Column:
        return count_or_zero(F.col(f"counts.{name}"))

    caption = F.coalesce(F.col("video.desc"), F.lit(""))
    shaped = counted.select(
        *carried,
        F.coalesce(filled(F.col("video.id")), filled(F.col("video.video.id"))).alias("id"),
        F.col("video.author.uniqueId").alias("author_username"),
        F.col("video.author.nickname").alias("author_nickname"),
        times.local_text(F.col("video.createTime"), settings.LOCAL_ZONE).alias("create_time"),
        count("diggCount").alias("likes"),
        count("shareCount").alias("shares"),
        count("commentCount").alias("comments"),
        count("playCount").alias("views"),
        count("collectCount").alias("saved"),
        F.substring(caption, 1, settings.CAPTION_CHARS).alias("caption"),
        F.col("keyword").alias("category"),
    ).where(F.col("id").isNotNull())
    unreadable = F.lit(False)
    for name in COUNTS:
        unreadable = unreadable | F.col(name).isNull()
    return shaped.withColumn("problem", F.when(unreadable, "unreadable count"))


def to_master_rows(records: DataFrame, crawled: Column) -> DataFrame:
    """Batch rows for the short-video master (no metrics)."""
    return records.select(
        *(c for c in ("seq", "pos") if c in records.columns),
        "id",
        "author_username",
        "author_nickname",
        "create_time",
        "caption",
        "category",
        crawled.alias("first_day_crawling"),
        crawled.alias("last_day_crawling"),
    )


def to_history_rows(records: DataFrame, crawled: Column) -> DataFrame:
    """History rows: every record with its crawl time."""
    return records.drop("problem").withColumn("crawl_date", crawled)


OUTPUT = (
    "id",
    "author_username",
    "author_nickname",
    "caption",
    "category",
    "views",
    "likes",
    "comments",
    "shares",
    "crawl_date",
)


def trending(
    history: DataFrame,
    as_of: str | datetime,
    category: str | None = None,
    hours: float = 168,
    min_views: int = 1000,
    limit: int = 20,
    dedupe: bool = False,
) -> DataFrame:
    """Recent observations by views; one video may fill several places.

    ``dedupe`` keeps only the best observation of each video.  Ties go by all
    remaining columns, so rows that come out in another order are equal.
    """
    ties = [c for c in OUTPUT if c not in ("id", "views", "crawl_date")]
    recent = history.where(times.since(history, "crawl_date", as_of, hours))
    chosen = filters.in_category(filters.at_least(recent, "views", min_views), category)
    if dedupe:
        chosen = first_rows(chosen, ["id"], [F.desc("views"), F.desc("crawl_date"), *ties], 1)
    return top(chosen, "views", ["id", "crawl_date", *ties], limit).select(*OUTPUT)
