"""Joins on keys that may be hot."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from snapmart.llm import importance, links, quality_rules


def test_large_sides_of_marks_give_the_same_rows(documents, awkward, monkeypatch):
    """Above the broadcast limit, with a third of all rows without an id."""
    docs = documents(awkward + [(None, f"copy {i % 3} of a text", "en", "s", None) for i in range(12)])
    target = documents([(1, None), (7, None), (99, None), (None, None)])

    def results():
        judged = quality_rules.judged(docs, target).select("doc_id", "n_words", "mean_ratio", "kept")
        kept = importance.resample(docs, target, 0.5).select("doc_id", "log_weight", "kept")
        return [sorted(map(tuple, frame.collect()), key=repr) for frame in (judged, kept)]

    small = results()
    monkeypatch.setattr(links, "fits_broadcast", lambda frame: False)
    assert results() == small


def test_rows_without_a_key_meet_in_no_single_task(spark, monkeypatch):
    monkeypatch.setattr(links, "fits_broadcast", lambda frame: False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rows = spark.range(3000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
        marks = spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("m"))
        joined = links.with_marks(rows, marks, "k")
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in tasks) == 3000 and max(r["count"] for r in tasks) < 1000


@pytest.mark.parametrize("kinds", [("bigint", "bigint"), ("string", "string"), ("int", "bigint"), ("double", "double")])
@pytest.mark.parametrize("most", [1 << 23, 1 << 6])
def test_marks_by_bits_are_those_of_a_plain_join(spark, monkeypatch, kinds, most):
    """Null, hot and repeated keys, marks without a row, hashes that all have a bit."""
    monkeypatch.setattr(links, "MOST_BITS", most)
    held = "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 7 = 0 THEN 5 WHEN id % 11 = 0 THEN -id ELSE id END"
    rows = spark.range(9000).selectExpr(f"cast({held} AS {kinds[0]}) AS k", "id % 50 AS v")
    marks = spark.range(5, 12000, 2).selectExpr(f"cast(id AS {kinds[1]}) AS k", "1 AS m")
    for some in (marks, marks.limit(0)):
        got, want = links.with_marks(rows, some, "k"), rows.join(some, "k", "left")
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_marks_are_not_broadcast(spark):
    """Neither as they are nor, as Spark would from the size of their file, once for each salt."""
    rows = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    marks = spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("m"))
    joined = links.with_marks(rows, marks, "k")
    assert joined.where("m = 1").count() == 100
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin [k" not in plan
    words, size = links._hash_bits(marks, "k")
    assert size == 1 << 19 and words.count() <= size // 64


def test_large_sides_of_marks_are_not_broadcast_once_a_salt(spark, monkeypatch):
    """Where not even their bits are sent."""
    monkeypatch.setattr(links, "fits_broadcast", lambda frame: False)
    rows = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    joined = links.with_marks(rows, rows.select("k", F.lit(1).alias("m")), "k")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
