"""The given tables seen as posts, snapshots, products and observations.

``*_SQL`` are the same views as common table expressions for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions import numbers, times

# Moment that splits observations into "already in the master" and "new batch".
SPLIT = "1998-05-01 00:00:00"
ORDER_SPLIT = "2000-06-01 00:00:00"

# Arrival order of line items (unique, unlike order key and line number).
LINE_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def event_number(props: str = "props") -> Column:
    """The k of an event's props."""
    return F.try_variant_get(F.try_parse_json(props), "$.k", "bigint")


EVENT_NUMBER_SQL = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


def cents(value: str) -> Column:
    return F.round(F.col(value) * 100).cast("bigint")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("author_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("category"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as snapshots of their order, with two tie columns."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("post_id"),
        F.col("l_shipdate").alias("snapshot_time"),
        F.col("l_quantity").cast("bigint").alias("likes"),
        F.col("l_linenumber").cast("bigint").alias("comments"),
        F.floor(F.col("l_extendedprice") / 1000).alias("shares"),
        F.col("l_partkey").alias("tie_1"),
        F.col("l_suppkey").alias("tie_2"),
    )


TIES = ("comments", "tie_1", "tie_2")

POSTS_SQL = """
posts AS (
  SELECT o_orderkey AS post_id, o_custkey AS author_id, o_orderdate AS created_at,
         o_orderpriority AS category
  FROM orders)"""

METRICS_SQL = """
metrics AS (
  SELECT l_orderkey AS post_id, l_shipdate AS snapshot_time,
         CAST(l_quantity AS BIGINT) AS likes, CAST(l_linenumber AS BIGINT) AS comments,
         CAST(floor(l_extendedprice / 1000) AS BIGINT) AS shares,
         l_partkey AS tie_1, l_suppkey AS tie_2
  FROM lineitem)"""

LATEST_SQL = """
latest AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY post_id
             ORDER BY snapshot_time DESC, comments DESC, tie_1 DESC, tie_2 DESC) AS place
    FROM metrics) WHERE place = 1)"""


def post_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as repeated captures of a post, for the posts master."""
    line = load(spark, sf_dir, "lineitem")
    return line.select(
        *LINE_ORDER,
        F.col("l_orderkey").alias("post_id"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("author_name"),
        F.col("l_suppkey").cast("string").alias("author_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("content"),
        F.array(
            F.concat(F.lit("u"), F.col("l_partkey").cast("string")),
            F.concat(F.lit("v"), F.col("l_suppkey").cast("string")),
        ).alias("media_urls"),
        # NULL for some first captures: the master has to keep that NULL.
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("created_at"),
        F.col("l_linestatus").alias("category"),
        F.lit("orders").alias("platform"),
        F.struct(
            F.col("l_linenumber").cast("string").alias("native_post_id"),
            F.col("l_suppkey").cast("string").alias("native_author_id"),
            F.col("l_linestatus").alias("post_type"),
            F.lit("table").alias("extraction_method"),
        ).alias("platform_data"),
        F.col("l_shipdate").alias("scraped_at"),
        F.date_format("l_shipdate", times.MINUTE).alias("crawl_session_id"),
        # A blank keyword must not enter the set.
        F.when(F.col("l_returnflag") == "N", F.lit(" "))
        .otherwise(F.col("l_returnflag"))
        .alias("keyword"),
    )


def video_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as repeated captures of a video (one per order)."""
    line = load(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    return line.select(
        *LINE_ORDER,
        F.col("l_orderkey").alias("video_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("title"),
        F.col("l_suppkey").cast("string").alias("channel_id"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("channel_title"),
        day.alias("published_at"),
        F.col("l_returnflag").alias("category"),
        F.lit("orders").alias("platform"),
        F.concat_ws(", ", "l_returnflag", "l_linestatus").alias("tags"),
        day.alias("first_crawl_date"),
        F.col("l_quantity").cast("bigint").alias("views"),
        F.col("l_linenumber").cast("bigint").alias("likes"),
        F.floor(F.col("l_extendedprice") / 1000).alias("comments"),
        F.trunc(day, "month").alias("last_crawl_date"),
    )


def short_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as repeated captures of a short video (one per customer)."""
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.col("o_custkey").alias("id"),
        F.col("o_orderstatus").alias("author_username"),
        F.col("o_orderpriority").alias("author_nickname"),
        F.date_format("o_orderdate", times.SECOND).alias("create_time"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("caption"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").alias("first_day_crawling"),
        F.col("o_orderdate").alias("last_day_crawling"),
    )


def product_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as repeated captures of a product (one per part)."""
    line = load(spark, sf_dir, "lineitem")
    after = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return line.select(
        *LINE_ORDER,
        "l_orderkey",
        F.col("l_partkey").alias("itemid"),
        F.col("l_suppkey").alias("shopid"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name"),
        after.alias("price"),
        F.col("l_extendedprice").alias("price_before_discount"),
        numbers.discount_text(F.col("l_extendedprice"), after).alias("discount"),
        F.col("l_linenumber").cast("bigint").alias("sold_recent"),
        (F.col("l_quantity") * F.col("l_linenumber")).cast("bigint").alias("sold_total"),
        numbers.two_places(F.col("l_tax") * 10).alias("rating_star"),
        F.col("l_quantity").cast("bigint").alias("rating_count"),
        (F.col("l_linestatus") == "O").alias("flash_sale"),
        F.date_format("l_shipdate", times.DAY).alias("ctime"),
        F.col("l_returnflag").alias("category"),
        F.col("l_shipdate").alias("first_day_crawling"),
        F.col("l_shipdate").alias("last_day_crawling"),
    )


# The split of one table into old and new needs the moment column by name.
def before(frame: DataFrame, moment: str, split: str) -> DataFrame:
    return frame.where(F.col(moment) < ntz(split))


def since(frame: DataFrame, moment: str, split: str) -> DataFrame:
    return frame.where(F.col(moment) >= ntz(split))
