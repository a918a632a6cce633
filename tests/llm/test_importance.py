"""Importance resampling against plain counts, and the k-th largest against sorting."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from snapmart.llm import importance, links


def test_weights_equal_plain_counts(spark, given):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    target = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in given.collect()}
    grams = {i: Counter(importance.buckets(t).tolist()) for i, t in texts.items()}
    raw, good = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in target:
            good.update(g)
    n_raw, n_good = sum(raw.values()), sum(good.values())
    prior = importance.PRIOR_COUNT
    ratio = {
        b: math.log((good[b] + prior) / (n_good * c / n_raw + prior)) for b, c in raw.items()
    }
    share = 0.8
    rows = importance.resample(given, labels.where("quality = 1"), share).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sum(ratio[b] * c for b, c in grams[r["doc_id"]].items())
        assert r["log_weight"] == pytest.approx(want, abs=1e-6)
        assert r["n_grams"] == sum(grams[r["doc_id"]].values())
    keys = sorted((r["gumbel_key"] for r in rows), reverse=True)
    k = math.ceil(share * len(rows))
    assert {r["gumbel_key"] for r in rows if r["kept"]} == set(keys[:k])


@pytest.mark.parametrize("seed", range(4))
def test_kth_largest(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1), 5.0, -1e12, 1e-300]) for _ in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 150, 299, 300):
        assert importance.kth_largest(frame, "v", k) == ordered[k - 1]


def test_good_documents_are_kept_and_junk_is_not(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = importance.resample(docs, labels.where("quality = 1"), importance.good_share(labels))
    rows = labels.join(kept, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.93 and sum(junk) / len(junk) < 0.6


def test_noise_is_gumbel(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'' AS text")
    none = docs.where("false")
    rows = importance.resample(docs, none, 0.25).collect()
    mean = sum(r["gumbel_key"] for r in rows) / len(rows)
    assert mean == pytest.approx(0.5772, abs=0.08)
    assert sum(r["kept"] for r in rows) == 1000


def test_awkward_documents(documents, awkward, spark):
    target = spark.createDataFrame([(1,), (1,), (None,), (99,)], "doc_id bigint")
    rows = importance.resample(documents(awkward), target, 0.5).collect()
    assert len(rows) == len(awkward)
    assert all(r["log_weight"] == 0 for r in rows if r["n_grams"] == 0)
    assert importance.resample(documents([]), target, 0.5).collect() == []
    assert importance.good_share(spark.createDataFrame([], "quality int")) == 1.0


def test_target_ids_are_not_sent_to_the_driver(spark, monkeypatch):
    plans = []

    def seen(rows, marks, key):
        joined = links.with_marks(rows, marks, key)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(importance, "with_marks", seen)
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('word w', id % 7) AS text")
    target = spark.range(0, 50_000, 2).selectExpr("id AS doc_id")
    total = importance.counts(docs, target, "doc_id", "text")
    assert total.sum(axis=1).tolist() == [90, 180]
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin [doc_id" not in plans[0]
