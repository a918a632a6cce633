"""Sinks, versions, catalog, and streams whose final state equals the batch result."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapmart.operators.dedup import keep_first
from snapmart.operators.merge import MergePolicy, reduce_batch
from snapmart.sources import responses, tables
from snapmart.streaming import jobs
from snapmart.workspace import new_folder, shared_root


def test_history_appends_and_keeps_repeats(spark, shared):
    frame = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (1, "2024-01-02 10:00:00")], "id bigint, t string"
    ).select("id", F.col("t").cast("timestamp_ntz").alias("crawl_date"))
    for _ in range(2):
        tables.append_history(frame, f"{shared}/history", "crawl_date")
    days = spark.read.parquet(f"{shared}/history").groupBy("crawl_day").count().collect()
    assert sorted((str(r.crawl_day), r["count"]) for r in days) == [
        ("2024-01-01", 2),
        ("2024-01-02", 2),
    ]


def test_versions_ignore_unfinished_ones(spark, shared):
    root = f"{shared}/master"
    assert tables.latest_version(spark, root) is None
    tables.write_version(spark.range(3), root, 4)
    tables.write_version(spark.range(5), root, 11)
    Path(f"{root}/upto=12").mkdir()
    assert tables.latest_version(spark, root) == 11
    assert tables.latest_version(spark, root, 10) == 4
    assert tables.read_version(spark, root, 4).count() == 3


def test_bucketed_master_needs_no_exchange_of_its_own(spark, shared):
    tables.create_namespace(spark, "bucketed", f"{shared}/bucketed")
    frame = spark.range(100).withColumn("v", F.col("id") * 2)
    tables.save_bucketed_master(frame, "bucketed", "m", "id", 4)
    master = tables.table(spark, "bucketed", "m")
    other = spark.range(50).withColumn("w", F.lit(1))
    plan = master.hint("merge").join(other, "id", "full_outer")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_json_export_keeps_unicode(spark, shared):
    named = spark.createDataFrame([("bàn ủi",)], "name string").coalesce(1)
    tables.export_json(named, f"{shared}/out")
    (part,) = Path(f"{shared}/out").glob("part-*.json")
    assert json.loads(part.read_text("utf-8")) == {"name": "bàn ủi"}
    assert "ủi" in part.read_text("utf-8")


def test_response_log(spark, shared):
    body = '{"text": "=== RESPONSE 9 ===",\n "b": 2}'
    folder = Path(shared) / "logs"
    folder.mkdir()
    (folder / "graphql_tủ_lạnh.json").write_text(
        f"=== RESPONSE 1 ===\n{body}\n\n=== RESPONSE 2 ===\n[1]\n\n", "utf-8"
    )
    rows = sorted(tuple(r) for r in responses.read_response_log(spark, str(folder)).collect())
    assert rows == [("tủ lạnh", 1, body), ("tủ lạnh", 2, "[1]")]


def test_landed_responses_have_the_fixed_schema(spark, shared):
    line = {"platform": "p", "keyword": "k", "seq": 1, "url": "u", "body": "{}", "extra": 1}
    Path(f"{shared}/landed.json").write_text(json.dumps(line))
    frame = responses.read_responses(spark, f"{shared}/landed.json", "json")
    assert frame.columns == ["platform", "keyword", "seq", "captured_at", "url", "body"]
    assert frame.first().seq == 1


def test_workspace_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == named
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(named)


POLICY = MergePolicy(
    key="id", insert_only=("first",), overwrite=("last",), add_to_set={"kws": "kw"}
)
SCHEMA = "id string, first string, last bigint, kw string, seq bigint, at timestamp"


@pytest.fixture
def landed(spark, shared):
    """Six files landed one after the other, one hot id in each."""
    rows = []
    for seq in range(120):
        key = "hot" if seq % 3 == 0 else f"k{seq % 17}"
        rows.append((key, f"f{seq}", seq % 7, "xyz"[seq % 3], seq))
    frame = spark.createDataFrame(rows, "id string, first string, last bigint, kw string, seq bigint")
    frame = frame.withColumn("at", F.timestamp_seconds(F.col("seq") + 1700000000))
    path = f"{shared}/landed"
    for n in range(6):
        part = frame.where(F.col("seq").between(n * 20, n * 20 + 19)).coalesce(1)
        part.write.mode("append").parquet(path)
    return path, frame


def stream_of(spark, path):
    from pyspark.sql.types import _parse_datatype_string

    return jobs.read_landed(spark, path, _parse_datatype_string(SCHEMA), files_per_trigger=1)


@pytest.mark.parametrize("fold_every", [1, 4])
def test_stream_merge_equals_batch(spark, shared, landed, fold_every):
    path, frame = landed
    stream = stream_of(spark, path)
    history, master, checkpoint = (f"{shared}/{n}" for n in ("history", "master", "checkpoint"))
    query = jobs.start_merge(stream, POLICY, ["seq"], history, master, checkpoint, fold_every)
    query.awaitTermination()
    folded = jobs.current_master(
        spark, POLICY, ["seq"], stream.schema, history, master, query.lastProgress["batchId"]
    )
    expected = reduce_batch(frame, POLICY, ["seq"])
    assert sorted(folded.select(*POLICY.columns).collect()) == sorted(
        expected.select(*POLICY.columns).collect()
    )
    assert tables.latest_version(spark, master) == (5 if fold_every == 1 else 3)

    # A replayed batch leaves the same master behind.
    again = jobs.fold_master(spark, POLICY, ["seq"], stream.schema, history, master, 5, 3)
    assert sorted(again.select(*POLICY.columns).collect()) == sorted(
        expected.select(*POLICY.columns).collect()
    )


def test_stream_first_seen_equals_batch(spark, shared, landed):
    path, frame = landed
    stream = stream_of(spark, path)
    query = jobs.start_first_seen(stream, ["id"], ["seq"], f"{shared}/seen", f"{shared}/ck")
    query.awaitTermination()
    accepted = jobs.read_first_seen(spark, f"{shared}/seen", stream.schema)
    expected = keep_first(frame, ["id"], ["seq"])
    assert sorted(r.seq for r in accepted.collect()) == sorted(r.seq for r in expected.collect())


def test_stream_watermark_dedup(spark, shared, landed):
    path, frame = landed
    stream = stream_of(spark, path).select("id", "at")
    distinct = jobs.drop_repeats(stream, ["id"], "at", "1 day")
    jobs.append_available(distinct, f"{shared}/ck2", f"{shared}/distinct").awaitTermination()
    ids = [r.id for r in spark.read.parquet(f"{shared}/distinct").collect()]
    assert sorted(ids) == sorted(r.id for r in frame.select("id").distinct().collect())


def test_dead_letters_are_appended(spark, shared):
    captured = spark.createDataFrame([(1, "{bad"), (2, "{}")], "seq bigint, body string")
    for _ in range(2):
        tables.append_rows(responses.undecodable(captured), f"{shared}/dead")
    assert [r.seq for r in spark.read.parquet(f"{shared}/dead").collect()] == [1, 1]


def test_history_without_regrouping_is_the_same(spark, shared):
    frame = spark.createDataFrame([(1, "2024-01-01 10:00:00")], "id bigint, t string").select(
        "id", F.col("t").cast("timestamp_ntz").alias("crawl_date")
    )
    tables.append_history(frame, f"{shared}/plain", "crawl_date", regroup=False)
    assert str(spark.read.parquet(f"{shared}/plain").first().crawl_day) == "2024-01-01"
