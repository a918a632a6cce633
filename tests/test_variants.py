"""Tolerant JSON reading."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from snapmart.functions import variants


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ('{"a":1}', '{"a":1}'),
        ('for (;;);{"a":1}', '{"a":1}'),
        ('while(1);{"a":1}', '{"a":1}'),
        ('while(true);{"a":1}', '{"a":1}'),
        ('junk{"a":1}', '{"a":1}'),
        ("junk[1]", "[1]"),
        ('{x}[{"a":1}]', '[{"a":1}]'),
        ("{bad", None),
        ("", None),
        (None, None),
        # Text behind the first value makes a body unreadable.
        ('{"a":1} x', None),
        ('{"a":1}{"a":2}', None),
        ('{"a":1}\n\n{"a":2}', None),
        ('{"a":1},{"a":2}', None),
        ('{"a":1}]', None),
        # The last of repeated keys counts.
        ('{"a":1,"a":2}', '{"a":2}'),
    ],
)
def test_decode_tolerant(spark, body, expected):
    frame = spark.createDataFrame([(body,)], "body string")
    decoded = frame.select(variants.decode_tolerant(F.col("body")).cast("string")).first()[0]
    assert decoded == expected


def test_decode_json_is_strict(spark):
    frame = spark.createDataFrame([('for (;;);{"a":1}',), (' {"a":1} ',)], "body string")
    rows = frame.select(variants.decode_json(F.col("body")).cast("string").alias("d")).collect()
    assert [r.d for r in rows] == [None, '{"a":1}']


@pytest.mark.parametrize(
    ("json", "expected"),
    [
        ("null", False),
        ("0", False),
        ("0.0", False),
        ("false", False),
        ('""', False),
        ("{}", False),
        ("[]", False),
        ('"0"', True),
        ('"{}"', True),
        ("7", True),
        ("true", True),
        ("[0]", True),
        ('{"a":null}', True),
    ],
)
def test_truthy(spark, json, expected):
    frame = spark.createDataFrame([(json,)], "j string")
    assert frame.select(variants.truthy(F.parse_json("j"))).first()[0] is expected


def test_truthy_of_a_missing_key(spark):
    frame = spark.createDataFrame([("{}",)], "j string")
    missing = variants.node_at(F.parse_json("j"), "$.a.b[0]")
    assert frame.select(variants.truthy(missing)).first()[0] is False


@pytest.mark.parametrize(
    ("json", "expected"),
    [
        ("12", 12),
        ('"12"', 12),
        ("12.7", 12),
        ("0", 0),
        ('""', 0),
        ("null", 0),
        ("{}", 0),
        ('"12.7"', None),
        ('"many"', None),
        ("[1]", None),
    ],
)
def test_truthy_long(spark, json, expected):
    frame = spark.createDataFrame([(json,)], "j string")
    assert frame.select(variants.truthy_long(F.parse_json("j"))).first()[0] == expected
