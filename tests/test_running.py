"""Caps and totals over micro-batches: any split, replays, batches that break off."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from snapmart.operators.dedup import cap_per_group
from snapmart.sources import buckets
from snapmart.streaming import jobs, running

ROWS = "grp string, kind string, seq bigint, amount decimal(10,2)"
KEPT = running.Totals(("grp",), ("amount", "seq"), ("seq",), ("seq",), ("kind",))


def arrivals(count=120, seed=5):
    """Rows in order of arrival: a hot group, a null group, values that are null."""
    rng = random.Random(seed)
    groups, kinds = ["hot", "hot", "a", "b", None], ["x", "y", "z", None]
    return [(rng.choice(groups), rng.choice(kinds), i) for i in range(count)]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "grp string, kind string, seq bigint")
    return made.withColumn("amount", (F.col("seq") / 4).cast("decimal(10,2)"))


def split(rows, ends):
    return [rows[a:b] for a, b in zip([0, *ends], [*ends, len(rows)], strict=True)]


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def totals_of(rows_frame):
    return rows_frame.groupBy("grp").agg(
        F.count(F.lit(1)), F.sum("amount"), F.sum("seq"), F.min("seq"), F.max("seq"), F.count_distinct("kind")
    )


@pytest.mark.parametrize("ends", [[5, 40, 40]])
def test_cap_and_totals_of_split_batches_are_those_of_one_batch(spark, shared, ends, monkeypatch):
    monkeypatch.setattr(buckets, "MOST_PARTS", 2)
    rows = arrivals()
    whole = frame(spark, rows)
    for v, part in enumerate(split(rows, ends)):
        batch = frame(spark, part)
        running.accept_capped(batch, v, ["grp"], ["seq"], 7, f"{shared}/cap", 4)
        running.add_batch(batch, v, KEPT, f"{shared}/sum", 4)
    capped = jobs.read_first_seen(spark, f"{shared}/cap", whole.schema)
    assert found(capped) == found(cap_per_group(whole, ["grp"], ["seq"], 7))
    made = running.read_totals(spark, KEPT, whole.schema, f"{shared}/sum")
    assert found(made) == found(totals_of(whole))
    # Counts of a group are added up when its folders are brought into one.
    newest = buckets.latest_manifest(spark, f"{shared}/cap/{running.TAKEN}")
    assert max((sum(b == p[0] for p in newest.parts) for b in range(4)), default=0) <= 2


def test_a_replayed_batch_takes_back_its_part(spark, shared):
    rows = arrivals()
    first, wrong, right = rows[:30], rows[20:70], rows[30:]
    for v, part in ((0, first), (1, wrong), (1, right)):
        batch = frame(spark, part)
        running.accept_capped(batch, v, ["grp"], ["seq"], 25, f"{shared}/cap", 4)
        running.add_batch(batch, v, KEPT, f"{shared}/sum", 4)
    whole = frame(spark, rows)
    capped = jobs.read_first_seen(spark, f"{shared}/cap", whole.schema)
    assert found(capped) == found(cap_per_group(whole, ["grp"], ["seq"], 25))
    assert found(running.read_totals(spark, KEPT, whole.schema, f"{shared}/sum")) == found(totals_of(whole))
    early = running.read_totals(spark, KEPT, whole.schema, f"{shared}/sum", upto=0)
    assert found(early) == found(totals_of(frame(spark, first)))


def test_a_batch_that_breaks_off_counts_once(spark, shared, monkeypatch):
    rows = arrivals(60)
    running.accept_capped(frame(spark, rows[:30]), 0, ["grp"], ["seq"], 15, shared, 4)

    def broken(*args):
        raise OSError("lost")

    late = frame(spark, rows[30:])
    with monkeypatch.context() as patched:
        patched.setattr(buckets, "write_manifest", broken)
        with pytest.raises(OSError, match="lost"):
            running.accept_capped(late, 1, ["grp"], ["seq"], 15, shared, 4)
    running.accept_capped(late, 1, ["grp"], ["seq"], 15, shared, 4)
    whole = frame(spark, rows)
    capped = jobs.read_first_seen(spark, shared, whole.schema)
    assert found(capped) == found(cap_per_group(whole, ["grp"], ["seq"], 15))


def test_empty_batches_and_empty_state(spark, shared):
    empty = spark.createDataFrame([], ROWS)
    assert found(running.read_totals(spark, KEPT, empty.schema, f"{shared}/sum")) == []
    running.accept_capped(empty, 0, ["grp"], ["seq"], 3, f"{shared}/cap", 4)
    assert found(jobs.read_first_seen(spark, f"{shared}/cap", empty.schema)) == []
