"""Quality rules against plain counts over the words of each text."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from snapmart.llm import quality_rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_given_documents(spark, given):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    texts = dict(given.select("doc_id", "text").collect())
    rows = quality_rules.judged(given, labels.where("quality = 1")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert tuple(r[n] for n in NAMES) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["mean_ratio"] >= quality_rules.THRESHOLD)


def test_awkward_documents(documents, awkward, spark):
    target = spark.createDataFrame([(1,), (1,), (None,), (99,)], "doc_id bigint")
    rows = quality_rules.judged(documents(awkward), target).collect()
    got = sorted(((r["doc_id"], *(r[n] for n in NAMES)) for r in rows), key=repr)
    assert got == sorted(((r[0], *plain(r[1])) for r in awkward), key=repr)
    assert quality_rules.judged(documents([]), target).collect() == []


def test_repeats_overlap_and_touch(documents):
    texts = ["a b c d e " * 3, "a " * 9, "a b c d e x a b c d e", "p q r s t u p q r s v p q r s t", "1 2 3 4 5 1 2 3 4 5 6"]
    rows = quality_rules.judged(documents(list(enumerate(texts))), documents([])).collect()
    assert all(r["n_repeat_words"] == plain(texts[r["doc_id"]])[4] for r in rows)
    assert all(r["mean_ratio"] == 0 for r in rows)


def test_ratio_equals_plain_multinomials(documents):
    docs = [(1, "good words in a good text"), (2, "bad bad words | bad"), (3, "good text in words")]
    target = documents([(1, None), (3, None)])
    hashed = quality_rules.base_counts(documents(docs)).select("doc_id", "_words").collect()
    ids = {r["doc_id"]: [h % quality_rules.BUCKETS for h in r["_words"]] for r in hashed}
    rows = {r["doc_id"]: r["mean_ratio"] for r in quality_rules.judged(documents(docs), target).collect()}
    # Pairs get their own buckets; with so few n-grams none collide.
    grams = {i: [*u, *zip(u, u[1:], strict=False)] for i, u in ids.items()}
    raw = Counter(g for u in grams.values() for g in u)
    good = Counter(g for i, u in grams.items() if i != 2 for g in u)
    prior, n_raw, n_good = quality_rules.PRIOR_COUNT, sum(raw.values()), sum(good.values())
    for i, u in grams.items():
        want = sum(
            math.log((good[g] + prior) / (n_good * raw[g] / n_raw + prior)) for g in u
        )
        assert rows[i] == pytest.approx(want / len(u), abs=1e-9)
    assert rows[2] < 0 < rows[1]


def test_held_out_junk_is_dropped_and_good_documents_are_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    trusted = labels.where("quality = 1 AND doc_id % 2 = 0")
    rows = labels.where("doc_id % 2 = 1").join(quality_rules.judged(docs, trusted), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.9 and sum(junk) / len(junk) < 0.2
