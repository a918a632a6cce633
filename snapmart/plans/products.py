"""Shop products: flattening, master, history and trending list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions import numbers, texts, times
from snapmart.functions.variants import count_or_zero
from snapmart.operators import filters
from snapmart.operators.merge import MergePolicy
from snapmart.operators.ranking import top
from snapmart.sources.responses import explode_records

# FIXED VALUES: the parts of a product element that are read.
ITEMS_PATH = "$.items"
ITEM_SHAPE = """
    struct<item_basic: struct<
      itemid: bigint, shopid: bigint, name: string,
      price: variant, price_min: variant, price_before_discount: variant,
      sold: variant, historical_sold: variant,
      item_rating: struct<rating_star: variant, rating_count: array<bigint>>,
      flash_sale: boolean, ctime: variant>>"""

FIELDS = (
    "shopid",
    "name",
    "price",
    "price_before_discount",
    "discount",
    "sold_recent",
    "sold_total",
    "rating_star",
    "rating_count",
    "flash_sale",
    "ctime",
    "category",
)

POLICY = MergePolicy(
    key="itemid",
    insert_only=(*FIELDS, "first_day_crawling"),
    overwrite=("last_day_crawling",),
)


def flatten(responses: DataFrame, zone: str = "UTC") -> DataFrame:
    """Product records; ``problem`` marks those with an unreadable price, rating or count.

    Defaults stand for missing keys only: an explicit null cannot be read.
    """
    items = explode_records(responses, ITEM_SHAPE, ITEMS_PATH)
    carried = [c for c in items.columns if c not in ("record", "keyword")]
    item = F.col("record.item_basic")
    zero = F.lit(0).cast("bigint")

    def amount(value: Column, missing: Column) -> Column:
        return F.when(value.isNull(), missing).otherwise(value.try_cast("double"))

    units = amount(item["price"], amount(item["price_min"], F.lit(0.0)))
    created = item["ctime"]
    shaped = items.select(
        *carried,
        item["itemid"].alias("itemid"),
        item["shopid"].alias("shopid"),
        texts.clean_spaces(F.coalesce(item["name"], F.lit(""))).alias("name"),
        numbers.from_price_units(units).alias("price"),
        numbers.from_price_units(amount(item["price_before_discount"], units)).alias(
            "price_before_discount"
        ),
        count_or_zero(item["sold"]).alias("sold_recent"),
        count_or_zero(item["historical_sold"]).alias("sold_total"),
        numbers.two_places(amount(item["item_rating"]["rating_star"], F.lit(0.0))).alias(
            "rating_star"
        ),
        F.coalesce(F.get(item["item_rating"]["rating_count"], F.lit(0)), zero).alias(
            "rating_count"
        ),
        F.coalesce(item["flash_sale"], F.lit(False)).alias("flash_sale"),
        # A missing time is epoch 0, an explicit null has no date.
        times.day_text(
            F.when(created.isNull(), zero).otherwise(created.try_cast("bigint")), zone
        ).alias("ctime"),
        F.col("keyword").alias("category"),
    )
    kept = filters.drop_without_key(shaped, "itemid")
    unreadable = (
        F.col("price").isNull()
        | F.col("price_before_discount").isNull()
        | F.col("rating_star").isNull()
    )
    uncounted = F.col("sold_recent").isNull() | F.col("sold_total").isNull()
    return kept.withColumns(
        {
            "discount": numbers.discount_text(F.col("price_before_discount"), F.col("price")),
            "problem": F.when(unreadable, "unreadable price or rating").when(
                uncounted, "unreadable count"
            ),
        }
    ).select(*carried, "itemid", *FIELDS, "problem")


def to_master_rows(records: DataFrame, crawled: Column) -> DataFrame:
    """Batch rows for the product master."""
    return records.select(
        *(c for c in ("seq", "pos") if c in records.columns),
        "itemid",
        *FIELDS,
        crawled.alias("first_day_crawling"),
        crawled.alias("last_day_crawling"),
    )


def to_history_rows(records: DataFrame, crawled: Column) -> DataFrame:
    """History rows: the whole product with its crawl time."""
    return records.select("itemid", *FIELDS, crawled.alias("crawl_date"))


OUTPUT = ("itemid", "name", "price", "discount", "sold_total", "rating_star", "category")


def trending(
    master: DataFrame, category: str | None = None, min_sales: int = 100, limit: int = 20
) -> DataFrame:
    """Products of the master by total sales as first seen."""
    chosen = filters.in_category(filters.at_least(master, "sold_total", min_sales), category)
    return top(chosen, "sold_total", ["itemid"], limit).select(*OUTPUT)
