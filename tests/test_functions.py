"""Scalar expressions: the edge cases that decide results."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions import numbers, texts, times


@pytest.mark.parametrize(
    ("shown", "expected"),
    [
        ("2.9K", 2900),
        ("1.5M", 1500000),
        ("298", 298),
        ("1,234", 1234),
        ("2,9K", 29000),
        (" 7 ", 7),
        ("1.2k", 1200),
        ("3 K", 3000),
        ("abc", 0),
        ("", 0),
        ("12.5", 0),
        ("1.2B", 0),
        ("1_000", 0),
        ("LIKE", None),
        ("K", None),
        ("1KM", None),
        ("5DK", None),
        (None, 0),
    ],
)
def test_parse_count(spark, shown, expected):
    frame = spark.createDataFrame([(shown,)], "s string")
    assert frame.select(numbers.parse_count(F.col("s"))).first()[0] == expected


@pytest.mark.parametrize(
    ("before", "after", "expected"),
    [
        (7990000.0, 5990000.0, "25%"),
        (8.0, 7.0, "12%"),
        (200.0, 165.0, "18%"),
        (200.0, 199.0, "0%"),
        (0.0, 5.0, "0%"),
        (100.0, 120.0, "-20%"),
    ],
)
def test_discount(spark, before, after, expected):
    frame = spark.createDataFrame([(before, after)], "b double, a double")
    assert frame.select(numbers.discount_text(F.col("b"), F.col("a"))).first()[0] == expected


def test_price_units_and_rounding(one):
    assert one(numbers.from_price_units(F.lit(599000000000))) == 5990000.0
    assert one(numbers.two_places(F.lit(4.125))) == 4.12
    assert one(numbers.with_separators(F.lit(1234567))) == "1,234,567"
    assert one(numbers.added(F.lit(1), F.lit(None).cast("int"))) is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a  \t b\n", "a b"),
        (" a　 b ", "a b"),
        ("a\x1cb", "a b"),
        ("   ", ""),
    ],
)
def test_clean_spaces(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "s string")
    assert frame.select(texts.clean_spaces(F.col("s"))).first()[0] == expected


def test_split_list(spark):
    frame = spark.createDataFrame([(" a, ,b ,", "x|y")], "s string, p string")
    row = frame.select(
        texts.split_list(F.col("s")).alias("c"), texts.split_list(F.col("p"), "|").alias("p")
    ).first()
    assert row.c == ["a", "b"]
    assert row.p == ["x", "y"]


@pytest.mark.parametrize(
    ("text", "keyword", "expected"),
    [
        ("Bán Tủ Lạnh cũ", "x", "refrigerator"),
        ("environment", "x", "iron"),
        ("rice cooker", "fridge", "refrigerator"),
        ("", "", "general"),
        (None, None, "general"),
        ("BÀN ỦI", "", "iron"),
    ],
)
def test_post_categories(spark, text, keyword, expected):
    frame = spark.createDataFrame([(text, keyword)], "t string, k string")
    lowered = [F.lower("k"), F.lower("t")]
    category = texts.category_of(lowered, settings.POST_CATEGORIES, settings.DEFAULT_CATEGORY)
    assert frame.select(category).first()[0] == expected


@pytest.mark.parametrize(
    ("title", "tags", "query", "expected"),
    [
        ("rice cooker", "", "fridge", "rice_cooker"),
        ("fridge", "", "", "general"),
        ("bếp từ", "", "", "stove"),
        (None, None, "Television", "tv"),
    ],
)
def test_video_categories(spark, title, tags, query, expected):
    from snapmart.plans.videos import classified

    frame = spark.createDataFrame([(title, tags, query)], "title string, tags string, keyword string")
    assert classified(frame).first()["category"] == expected


def test_surrogate_number_is_stable(one):
    number = texts.surrogate_number(F.lit("Lan"), settings.SURROGATE_MODULUS)
    first, again = one(number), one(number)
    assert first == again
    assert 0 <= first < settings.SURROGATE_MODULUS


def test_times(one):
    epoch = F.lit(1700000000)
    assert one(times.local_text(epoch, settings.LOCAL_ZONE)) == "2023-11-15 05:13:20"
    assert one(times.local_text(F.lit(0), settings.LOCAL_ZONE)) == ""
    assert one(times.local_text(F.lit(None).cast("bigint"), "UTC")) == ""
    assert one(times.day_text(F.lit(0))) == "1970-01-01"
    assert one(times.day_text(F.lit(None).cast("bigint"))) == ""
    assert one(times.day_text(F.lit(1700000000 + 7 * 3600), "Asia/Ho_Chi_Minh")) == "2023-11-15"
    assert one(times.instant(F.lit(0))) is None
    assert one(times.instant(F.lit(10**18))) is None
    assert one(times.wall_clock(epoch)) == datetime(2023, 11, 14, 22, 13, 20)
    assert one(times.epoch_seconds(times.wall_clock(epoch))) == 1700000000
    assert one(times.iso_day(F.lit("2024-05-06T10:00:00Z"))) == "2024-05-06"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string", "date"])
def test_since_bound_takes_the_column_type(spark, kind):
    days = spark.createDataFrame(
        [("2024-01-01 00:00:00",), ("2024-01-03 00:00:00",), (None,)], "t string"
    ).select(F.col("t").cast(kind))
    kept = days.where(times.since(days, "t", "2024-01-04 00:00:00", 48))
    assert kept.count() == 1
