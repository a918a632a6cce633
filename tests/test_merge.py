"""Merge policies, their status, and properties of repeated merges."""

from __future__ import annotations

import random

import pytest

from snapmart.operators.merge import (
    STATUS,
    MergePolicy,
    merge_counters,
    merge_master,
    merge_small_batch,
    reduce_batch,
)

POLICY = MergePolicy(
    key="id", insert_only=("content", "born"), overwrite=("seen",), add_to_set={"kws": "kw"}
)
BATCH = "id string, content string, born string, seen bigint, kw string, seq bigint"
MASTER = "id string, content string, born string, seen bigint, kws array<string>"


def batch_of(spark, *rows):
    return spark.createDataFrame(list(rows), BATCH)


def master_of(spark, *rows):
    return spark.createDataFrame(list(rows), MASTER)


def result(merged):
    return {
        r.id: (r.content, r.born, r.seen, r.kws, r[STATUS]) for r in merged.collect()
    }


def test_policies(spark):
    master = master_of(
        spark,
        ("old", "c0", None, 1, ["x"]),
        ("same", "c0", "b", 1, ["x"]),
        ("rest", "c0", "b", 1, ["x"]),
        ("noset", "c0", "b", 1, None),
    )
    batch = batch_of(
        spark,
        ("old", "c1", "later", 2, "y", 1),
        ("same", "c1", "b1", 1, "x", 2),
        ("new", "first", "b", 5, "q", 3),
        ("new", "second", "b2", 6, "p", 4),
        ("noset", "c1", "b", 1, "z", 5),
        ("", "no key", "b", 1, "x", 6),
        (None, "no key", "b", 1, "x", 7),
    )
    assert result(merge_master(master, batch, POLICY, ["seq"])) == {
        "old": ("c0", None, 2, ["x", "y"], "changed"),
        "same": ("c0", "b", 1, ["x"], "matched"),
        "rest": ("c0", "b", 1, ["x"], "untouched"),
        "new": ("first", "b", 6, ["p", "q"], "inserted"),
        "noset": ("c0", "b", 1, ["z"], "changed"),
    }


def test_blank_keywords_stay_out_of_the_set(spark):
    batch = batch_of(spark, ("a", "c", "b", 1, "", 1), ("a", "c", "b", 1, " ", 2))
    merged = merge_master(master_of(spark), batch, POLICY, ["seq"])
    assert result(merged)["a"][3] == []


def test_first_and_last_values_may_be_null(spark):
    batch = batch_of(spark, ("a", None, "b", 1, "k", 1), ("a", "c", "b2", None, "k", 2))
    row = reduce_batch(batch, POLICY, ["seq"]).first()
    assert (row.content, row.born, row.seen) == (None, "b", None)


def test_a_null_overwrites_and_counts_as_change(spark):
    master = master_of(spark, ("a", "c", "b", 1, ["k"]))
    batch = batch_of(spark, ("a", "c", "b", None, "k", 1))
    assert result(merge_master(master, batch, POLICY, ["seq"]))["a"][2:] == (None, ["k"], "changed")


def random_rows(seed, n=400, keys=40):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        # A third of all rows belongs to one key.
        key = "hot" if rng.random() < 0.33 else f"k{rng.randrange(keys)}"
        rows.append(
            (key, f"c{seq}", rng.choice([None, "b"]), rng.randrange(5), rng.choice("xyz"), seq)
        )
    return rows


def brute_force(rows):
    found = {}
    for key, content, born, seen, kw, _ in rows:
        if key not in found:
            found[key] = [content, born, seen, {kw}]
        else:
            found[key][2] = seen
            found[key][3].add(kw)
    return {k: (c, b, s, sorted(kws)) for k, (c, b, s, kws) in found.items()}


def master_rows(frame):
    return {r.id: (r.content, r.born, r.seen, r.kws) for r in frame.collect()}


@pytest.mark.parametrize("merge", [merge_master, merge_small_batch])
def test_split_batches_equal_one_batch(spark, merge):
    rows = random_rows(3)
    expected = brute_force(rows)
    whole = reduce_batch(batch_of(spark, *rows), POLICY, ["seq"])
    assert master_rows(whole) == expected
    first = reduce_batch(batch_of(spark, *rows[:150]), POLICY, ["seq"])
    shuffled = rows[150:]
    random.Random(4).shuffle(shuffled)
    second = merge(first, batch_of(spark, *shuffled).repartition(5), POLICY, ["seq"])
    assert master_rows(second) == expected


def test_merging_the_same_batch_again_changes_nothing(spark):
    rows = random_rows(5, n=120)
    batch = batch_of(spark, *rows)
    once = merge_master(master_of(spark), batch, POLICY, ["seq"]).drop(STATUS)
    again = merge_master(once, batch, POLICY, ["seq"])
    assert master_rows(again) == master_rows(once)
    assert {r[STATUS] for r in again.select(STATUS).distinct().collect()} == {"matched"}


def test_small_batch_way_equals_the_general_way(spark):
    rows = random_rows(6)
    master = reduce_batch(batch_of(spark, *rows[:300]), POLICY, ["seq"])
    batch = batch_of(spark, *rows[300:310], ("brand new", "c", "b", 1, "k", 999))
    general = result(merge_master(master, batch, POLICY, ["seq"]))
    assert result(merge_small_batch(master, batch, POLICY, ["seq"])) == general
    assert result(merge_small_batch(master, batch, POLICY, ["seq"], limit=0)) == general
    assert {"untouched", "inserted"} <= {v[4] for v in general.values()}


def test_counters(spark):
    master = master_of(spark, ("a", "c", "b", 1, ["x"]), ("b", "c", "b", 1, ["x"]))
    batch = batch_of(
        spark,
        ("a", "c", "b", 1, "x", 1),
        ("b", "c", "b", 2, "x", 2),
        ("b", "c", "b", 3, "x", 3),
        ("n", "c", "b", 3, "x", 4),
        (None, "c", "b", 3, "x", 5),
    )
    merged = merge_master(master, batch, POLICY, ["seq"])
    row = merge_counters(merged, batch, POLICY).first().asDict()
    assert merge_counters(merged, batch, POLICY, batch.limit(2)).first()["errors"] == 3
    assert row == {
        "inserted": 1,
        "updated": 1,
        "matched": 2,
        "history_inserted": 4,
        "errors": 1,
    }


def test_set_of_scalar_column_only(spark):
    policy = MergePolicy(key="id", insert_only=("a",), overwrite=("b",))
    batch = spark.createDataFrame([("k", 1, 2, 1)], "id string, a int, b int, seq int")
    merged = merge_master(
        spark.createDataFrame([("k", 9, 9)], "id string, a int, b int"), batch, policy, ["seq"]
    )
    assert [tuple(r) for r in merged.collect()] == [("k", 9, 2, "changed")]
