"""Tables in buckets: shared files, versions that break off, bounded numbers of files."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapmart.operators.dedup import keep_first
from snapmart.operators.merge import MergePolicy, merge_buckets, read_buckets, reduce_batch
from snapmart.sources import buckets
from snapmart.streaming import jobs

POLICY = MergePolicy("id", insert_only=("first",), overwrite=("last",), add_to_set={"kinds": "kind"})
BATCH = "id bigint, seq bigint, first string, last string, kind string"


def batch(spark, ids, name):
    return spark.createDataFrame([(i, k, f"{name}{k}", f"{name}{k}", name) for k, i in enumerate(ids)], BATCH)


def rows(frame):
    return sorted(map(tuple, frame.select(*POLICY.columns).collect()))


def test_merges_equal_one_reduction_and_share_untouched_files(spark, shared):
    root = f"{shared}/master"
    batches = [batch(spark, range(40), "a"), batch(spark, [3, 3, 100], "b"), batch(spark, [None, 0], "c")]
    made = [merge_buckets(b, POLICY, ["seq"], root, v, 8) for v, b in enumerate(batches)]
    hit = set(buckets.buckets_hit(batches[1].where("id > 0"), ["id"], 8))
    assert 0 < len(hit) < 8
    shared_parts = set(made[0].parts) & set(made[1].parts)
    assert {b for b, _ in shared_parts} == {b for b, _ in made[0].parts} - hit
    assert made[2].parts == made[1].parts  # no key at all
    numbered = [b.withColumn("at", F.lit(v)) for v, b in enumerate(batches)]
    together = reduce_batch(numbered[0].union(numbered[1]).union(numbered[2]), POLICY, ["at", "seq"])
    assert rows(read_buckets(spark, POLICY, batches[0], root)) == rows(together)
    first = reduce_batch(batches[0], POLICY, ["seq"])
    assert rows(read_buckets(spark, POLICY, batches[0], root, 0)) == rows(first)


def test_a_merge_that_breaks_off_leaves_the_old_version(spark, shared, monkeypatch):
    root = f"{shared}/master"
    merge_buckets(batch(spark, range(10), "a"), POLICY, ["seq"], root, 0, 4)
    before = rows(read_buckets(spark, POLICY, batch(spark, [], "x"), root))

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(buckets, "write_manifest", broken)
        with pytest.raises(OSError, match="lost"):
            merge_buckets(batch(spark, range(5), "b"), POLICY, ["seq"], root, 1, 4)
    Path(f"{root}/manifests/v=1").mkdir()  # begun and not finished
    assert buckets.latest_manifest(spark, root).version == 0
    assert rows(read_buckets(spark, POLICY, batch(spark, [], "x"), root)) == before
    again = merge_buckets(batch(spark, range(5), "b"), POLICY, ["seq"], root, 1, 4)
    assert merge_buckets(batch(spark, range(5), "b"), POLICY, ["seq"], root, 1, 4).version == again.version
    assert {r[2] for r in rows(read_buckets(spark, POLICY, batch(spark, [], "x"), root)) if r[0] in range(1, 5)} == {
        "b1", "b2", "b3", "b4"
    }


def test_expired_versions_are_removed_with_their_files(spark, shared):
    root = f"{shared}/master"
    for v in range(4):
        merge_buckets(batch(spark, [1, 2, 3 + v], f"n{v}"), POLICY, ["seq"], root, v, 4)
    kept = rows(read_buckets(spark, POLICY, batch(spark, [], "x"), root))
    buckets.expire(spark, root, keep=2)
    assert sorted(p.name for p in Path(f"{root}/manifests").iterdir()) == ["v=2", "v=3"]
    used = {f for v in (2, 3) for _, f in buckets.read_manifest(spark, root, v).parts}
    assert {p.name for p in Path(f"{root}/data").iterdir()} == used
    assert rows(read_buckets(spark, POLICY, batch(spark, [], "x"), root)) == kept


def test_files_opened_do_not_grow_with_the_number_of_versions(spark, shared, monkeypatch):
    monkeypatch.setattr(buckets, "MOST_PARTS", 3)
    root, base, opened = f"{shared}/ids", buckets.Manifest(-1, 4), []
    for v in range(9):
        ids = spark.range(5 * v, 5 * v + 5).coalesce(1)
        base = buckets.add_rows(ids, root, ["id"], base, v)
        opened.append(len(buckets.read_parts(spark, root, base.parts, ids.schema).inputFiles()))
    assert max(opened) <= 4 * 3
    found = buckets.read_parts(spark, root, base.parts, ids.schema)
    assert sorted(r["id"] for r in found.collect()) == list(range(45))


def test_first_seen_over_many_batches(spark, shared):
    path, root = f"{shared}/landed", f"{shared}/seen"
    parts = [[(i % 7, 10 * p + i) for i in range(p, p + 5)] + [(None, 10 * p + 9)] for p in range(5)]
    made = []
    for k, part in enumerate(parts):
        frame = spark.createDataFrame(part, "id bigint, seq bigint").withColumn("at", F.lit(k))
        frame.coalesce(1).write.mode("append").parquet(path)
        made.append(frame)
    stream = jobs.read_landed(spark, path, frame.schema, files_per_trigger=1)
    jobs.start_first_seen(stream, ["id"], ["seq"], root, f"{shared}/ck", 4).awaitTermination()
    together = made[0].union(made[1]).union(made[2]).union(made[3]).union(made[4])
    wanted = keep_first(together, ["id"], ["at", "seq"])
    accepted = jobs.read_first_seen(spark, root, stream.schema)
    assert sorted(map(tuple, accepted.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
    known = buckets.latest_manifest(spark, f"{root}/_known")
    assert known.version == 4 and known.buckets == 4
