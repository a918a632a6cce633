"""Late responses: the streamed join against the batch join, for any order of landing."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from snapmart.streaming import jobs, requests
from snapmart.workspace import new_folder

CLOSED = "9999-01-01 00:00:00"
ASKED = [[(1, "a", "10:00"), (2, "b", "10:05")], [(3, "c", "11:00"), (4, "d", "12:00")]]
GIVEN = [
    [(3, "x", "11:30"), (1, "y", "10:00"), (9, "nobody asked", "10:10"), (None, "no key", "10:20")],
    [(2, "z", "10:50"), (1, "second", "10:30"), (4, "before", "11:59"), (2, "too long after", "12:30")],
]
WANTED = {
    ("x", "c", "matched"), ("y", "a", "matched"), ("z", "b", "matched"), ("second", "a", "matched"),
    ("nobody asked", None, "orphan"), ("no key", None, "orphan"), ("before", None, "orphan"),
    ("too long after", None, "orphan"),
}


def frames(spark, parts, value, moment):
    made = []
    for rows in parts:
        frame = spark.createDataFrame(rows, f"id int, {value} string, {moment} string")
        made.append(frame.withColumn(moment, F.concat(F.lit("2024-01-01 "), moment).cast("timestamp")))
    return made


def landed(spark, parts, moment):
    path = new_folder(spark, "landed")
    for part in [*parts, *[requests.closing_rows(parts[0], "id", moment, CLOSED)] * 2]:
        part.coalesce(1).write.mode("append").parquet(path)
    return jobs.read_landed(spark, path, parts[0].schema, files_per_trigger=1)


def joined(asked, given, delay):
    return requests.answered(asked, given, "id", "asked_at", "arrived_at", "60 MINUTES", delay)


def run(spark, asked, given, delay):
    both = joined(landed(spark, asked, "asked_at"), landed(spark, given, "arrived_at"), delay)
    matched, orphans = new_folder(spark, "matched"), new_folder(spark, "orphans")
    query = requests.start_answered(both, matched, orphans, new_folder(spark, "checkpoint"), "arrived_at", CLOSED)
    requests.finished(query)
    return [requests.read_written(spark, both.schema, root) for root in (matched, orphans)]


def rows(*written):
    return [(r["item"], r["category"], r["status"]) for frame in written for r in frame.collect()]


def test_batch(spark):
    asked, given = frames(spark, ASKED, "category", "asked_at"), frames(spark, GIVEN, "item", "arrived_at")
    found = rows(joined(asked[0].union(asked[1]), given[0].union(given[1]), "1 day"))
    assert len(found) == 8 and set(found) == WANTED


@pytest.mark.parametrize(("one", "two"), list(itertools.product([1, -1], [1, -1])))
def test_any_order_of_files(spark, one, two):
    asked, given = frames(spark, ASKED, "category", "asked_at"), frames(spark, GIVEN, "item", "arrived_at")
    matched, orphans = run(spark, asked[::one], given[::two], "1 day")
    assert len(rows(matched, orphans)) == 8 and set(rows(matched, orphans)) == WANTED
    assert {r[2] for r in rows(matched)} == {"matched"} and {r[2] for r in rows(orphans)} == {"orphan"}


def test_rows_behind_the_watermark_are_an_error(spark):
    asked = frames(spark, [[(1, "a", "20:00")], [(2, "b", "21:00")], [(3, "c", "08:00")]], "category", "asked_at")
    given = frames(spark, [[(1, "x", "20:10")], [(2, "y", "21:10")], [(3, "z", "08:10")]], "item", "arrived_at")
    with pytest.raises(requests.RowsTooLate, match="behind the watermark"):
        run(spark, asked, given, "1 minute")
