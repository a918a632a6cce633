"""Frame operators: keep-first, caps, newest snapshot, counts, keywords, ranking."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.operators import dedup, filters, keywords, latest, ranking, reports
from snapmart.operators.lookups import hits_with_details
from snapmart.operators.sizing import fits_broadcast, measured_bytes
from snapmart.plans import posts, shorts


def test_keep_first_takes_arrival_order(spark):
    rows = [("a", 1), ("b", 2), ("a", 3)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "id string, seq bigint")
    assert sorted(dedup.keep_first(frame, ["id"], ["seq"]).collect()) == [("a", 1), ("b", 2)]


def test_keep_first_in_scopes(spark):
    rows = [("x", "a", 1), ("y", "a", 2), ("x", "a", 3)]
    frame = spark.createDataFrame(rows, "kw string, id string, seq bigint")
    kept = dedup.keep_first(frame, ["id"], ["seq"], scope=["kw"])
    assert sorted(r.seq for r in kept.collect()) == [1, 2]


@pytest.mark.parametrize("count", [1, 7, 1000, 1001, 2500])
def test_cap_equals_brute_force_with_a_hot_group(spark, count):
    groups = ["hot"] * 3000 + ["cold"] * 5 + [None] * 2
    random.Random(2).shuffle(groups)
    rows = [(g, n) for n, g in enumerate(groups)]
    frame = spark.createDataFrame(rows, "kw string, seq bigint").repartition(6)
    expected = []
    for group in ("hot", "cold", None):
        expected += sorted(n for g, n in rows if g == group)[:count]
    capped = dedup.cap_per_group(frame, ["kw"], ["seq"], count)
    assert sorted(r.seq for r in capped.collect()) == sorted(expected)


def test_known_and_new(spark):
    batch = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    known = spark.createDataFrame([(2,), (2,), (3,), (None,)], "id bigint")
    assert sorted(dedup.split_known(batch, known, "id").collect()) == [(1, False), (2, True)]
    assert [r.id for r in dedup.not_seen(batch, known, "id").where("id > 0").collect()] == [1, 1]


def test_hits_with_details(spark):
    hits = spark.createDataFrame(
        [("q", "a", 2), ("q", "a", 1), ("r", "a", 3), ("q", "z", 4)],
        "kw string, video_id string, seq bigint",
    )
    details = spark.createDataFrame([("a", "A")], "video_id string, title string")
    found = hits_with_details(hits, details, "video_id", ["seq"], scope=["kw"])
    assert sorted((r.kw, r.seq, r.title) for r in found.collect()) == [("q", 1, "A"), ("r", 3, "A")]


SNAPSHOTS = [
    (1, "2024-01-01 00:00:00", 5, 0),
    (1, "2024-01-02 00:00:00", 6, 0),
    (1, "2024-01-02 00:00:00", 7, 1),
    (2, "2024-01-03 00:00:00", 8, 0),
]


def snapshots(spark):
    frame = spark.createDataFrame(SNAPSHOTS, "post_id bigint, t string, likes bigint, tie int")
    return frame.withColumn("snapshot_time", F.col("t").cast("timestamp")).drop("t")


def test_latest_and_attachment(spark):
    newest = latest.latest_per_key(snapshots(spark), "post_id", "snapshot_time", ["tie"])
    assert sorted((r.post_id, r.likes) for r in newest.collect()) == [(1, 7), (2, 8)]
    entities = spark.createDataFrame([(1, "a"), (3, "c")], "post_id bigint, name string")
    args = (entities, snapshots(spark), "post_id", "snapshot_time", ["tie"])
    plain = latest.attach_latest(*args)
    assert [(r.post_id, r.latest_metrics.likes) for r in plain.collect()] == [(1, 7)]
    for limit in (0, settings.BROADCAST_BYTES):
        chosen = latest.attach_latest_selective(*args, limit=limit)
        assert sorted(chosen.collect()) == sorted(plain.collect())


def test_global_latest(spark):
    entities = spark.createDataFrame([(1, "a"), (3, "c")], "post_id bigint, name string")
    attached = latest.attach_global_latest(
        entities, snapshots(spark), "post_id", "snapshot_time", ["tie"]
    )
    found = sorted((r.post_id, r.latest_metrics.likes) for r in attached.collect())
    assert found == [(1, 8), (3, 8)]
    none = latest.attach_global_latest(
        entities, snapshots(spark).where("likes > 99"), "post_id", "snapshot_time"
    )
    assert none.count() == 0


def _posts(spark, rows):
    frame = spark.createDataFrame(rows, "post_id bigint, created string, category string")
    return frame.withColumn("created_at", F.col("created").cast("timestamp")).drop("created")


def _metrics(spark, rows):
    frame = spark.createDataFrame(
        rows, "post_id bigint, t string, likes bigint, comments bigint, shares bigint"
    )
    return frame.withColumn("snapshot_time", F.col("t").cast("timestamp")).drop("t")


def test_trending_posts_rules(spark):
    recent, old = "2024-01-09 00:00:00", "2024-01-01 00:00:00"
    given = _posts(
        spark,
        [
            (1, recent, "tv"),
            (2, recent, "tv"),
            (3, recent, "fan"),
            (4, old, "tv"),
            (5, None, "tv"),
            (6, recent, "tv"),
            (7, recent, "tv"),
            (8, recent, "tv"),
        ],
    )
    metrics = _metrics(
        spark,
        [
            (2, recent, 5, 3, 2),
            (1, recent, 10, 0, 0),
            (1, old, 99, 99, 99),
            (3, recent, 50, 0, 0),
            (4, recent, 70, 0, 0),
            (5, recent, 70, 0, 0),
            (7, recent, 9, 0, 0),
            (8, recent, None, 50, 50),
        ],
    )
    as_of = "2024-01-10 00:00:00"
    every = posts.trending(given, metrics, as_of)
    assert [(r.post_id, r.total_engagement) for r in every.collect()] == [(3, 50), (1, 10), (2, 10)]
    assert every.columns == [
        "post_id",
        "category",
        "created_at",
        "latest_metrics",
        "total_engagement",
    ]
    tv = posts.trending(given, metrics, as_of, category="tv", min_engagement=1)
    assert [r.post_id for r in tv.collect()] == [1, 2, 7]
    assert posts.trending(given, metrics, as_of, category="").count() == 3


def test_trending_posts_is_cut_to_twenty(spark):
    recent = "2024-01-09 00:00:00"
    given = _posts(spark, [(n, recent, "tv") for n in range(25)])
    metrics = _metrics(spark, [(n, recent, 100 - n // 2, 0, 0) for n in range(25)])
    best = posts.trending(given, metrics, "2024-01-10 00:00:00")
    assert [r.post_id for r in best.collect()] == list(range(20))


def test_trending_history_repeats_an_id_unless_deduped(spark):
    rows = [("a", 5000, "2024-01-09 00:00:00"), ("a", 4000, "2024-01-08 00:00:00")]
    rows += [("b", 10, "2024-01-09 00:00:00"), ("c", 9000, "2023-12-01 00:00:00")]
    history = spark.createDataFrame(rows, "id string, views bigint, crawl_date string")
    for column in shorts.OUTPUT:
        if column not in history.columns:
            history = history.withColumn(column, F.lit(None).cast("string"))
    as_of = datetime(2024, 1, 10)
    assert [r.views for r in shorts.trending(history, as_of).collect()] == [5000, 4000]
    assert [r.views for r in shorts.trending(history, as_of, dedupe=True).collect()] == [5000]


def test_ranks(spark):
    frame = spark.createDataFrame([(1, 5), (2, 9), (3, 5)], "id bigint, n bigint")
    ranked = ranking.with_rank(ranking.top(frame, "n", ["id"], 2), "n", ["id"])
    assert sorted((r["rank"], r.id) for r in ranked.collect()) == [(1, 2), (2, 1)]


def test_counts_per_keyword(spark):
    records = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "kw string")
    counted = reports.counts_per_keyword(records, ["a", " b ", "", "a"], "kw")
    assert sorted(counted.collect()) == [("a", 2), ("b", 0)]


def test_totals_and_platform_rows(spark):
    records = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    counted = reports.totals(records, "id")
    assert tuple(counted.first()) == (3, 2)
    failed = reports.platform_row("x", counted, "e" * 200).first()
    assert failed.status == "FAILED: " + "e" * 100
    assert reports.platform_row("x", counted).first().status == "SUCCESS"


def test_filters(spark):
    rows = [("", ["u"]), ("t", []), ("", []), (None, None)]
    frame = spark.createDataFrame(rows, "text string, attachments array<string>")
    assert filters.with_content(frame, "text", "attachments").count() == 2
    ids = spark.createDataFrame([(0, ""), (None, None), (5, "x")], "n bigint, s string")
    assert filters.drop_without_key(ids, "n").count() == 1
    assert filters.drop_without_key(ids, "s").count() == 1
    titles = spark.createDataFrame(
        [(" Yến Nồi Cơm Điện Official ",), ("",), (None,), ("other",)], "title string"
    )
    assert filters.exclude_channels(titles, "title", settings.EXCLUDED_CHANNELS).count() == 3
    words = spark.createDataFrame([(" ",), ("",), (None,), (" a ",), ("\t\n",)], "kw string")
    assert filters.drop_blank(words, "kw").count() == 1
    assert filters.at_least(ids, "n", 0).count() == 2


def test_keyword_phrases(spark):
    frame = spark.createDataFrame([("tv",)], "kw string")
    rows = keywords.expand_keywords(frame, "kw", settings.SHORT_TEMPLATES).collect()
    assert [r.phrase for r in rows][:2] == ["tv", "review tv"]
    assert [r.variant_no for r in rows] == list(range(10))
    few = keywords.expand_keywords(frame, "kw", settings.PRODUCT_TEMPLATES, 3).collect()
    assert [r.phrase for r in few] == ["tv", "tv giá rẻ", "tv tốt nhất"]


def test_tagging_text(spark):
    texts = spark.createDataFrame([(1, "Mua TV sale"), (2, "none")], "id bigint, text string")
    tagged = keywords.tag_with_keywords(texts, "text", ["tv", "fan"], settings.SHORT_TEMPLATES)
    found = sorted((r.id, r.base_keyword, r.phrase) for r in tagged.collect())
    assert found == [(1, "tv", "mua tv"), (1, "tv", "tv"), (1, "tv", "tv sale")]


def test_measured_size_bounds_the_text(spark):
    frame = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    assert measured_bytes(frame) >= 10_000
    assert fits_broadcast(frame, 100_000)
    assert not fits_broadcast(frame, 9_999)
    assert measured_bytes(frame.where("s = ''")) == 0


@pytest.mark.parametrize("count", [400, 1500])
def test_cap_of_rows_with_a_map(spark, count):
    rows = [("hot", n, {"like": n}) for n in range(2000)]
    frame = spark.createDataFrame(rows, "kw string, seq bigint, reactions map<string, int>")
    capped = dedup.cap_per_group(frame, ["kw"], ["seq"], count)
    assert sorted(r.seq for r in capped.select("seq").collect()) == list(range(count))
