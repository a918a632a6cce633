"""The toxicity network: gradients, windows, and documents it has not seen."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from snapmart.llm import toxicity as tox


@pytest.fixture(scope="module")
def params():
    texts = [b"you are a stupid idiot and worse", b"what a lovely calm day it is", b"such a stupid mess", b"all is well"] * 6
    return tox.train(texts, [1, 0, 1, 0] * 6)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    params = tox.train([b"a b", b"c d"], [0, 1])
    params = {k: v.astype(np.float64) for k, v in params.items()}
    words = [f"w{i}".encode() for i in range(7)]
    ids = rng.integers(0, 7, (tox.WINDOW, 3))
    sizes = np.array([tox.WINDOW, 5, 0])
    ids = np.where(np.arange(tox.WINDOW)[:, None] < sizes, ids, 0)
    vectors = tox.embed(params, tox.word_features(words)).astype(np.float64)
    up = np.array([0.3, -1.0, 0.5], np.float32)

    def value(p):
        logits, cache = tox.window_logits(p, tox.project(p, vectors), ids, sizes, keep=True)
        return float((logits * up).sum()), cache

    _, cache = value(params)
    grads = tox._gradients(params, vectors, ids, sizes, up, cache)
    for name, grad in grads.items():
        for at in [tuple(rng.integers(0, s) for s in grad.shape) for _ in range(4)]:
            moved = {k: v.copy() for k, v in params.items()}
            step = 1e-2
            moved[name][at] += step
            high = value(moved)[0]
            moved[name][at] -= 2 * step
            low = value(moved)[0]
            assert grad[at] == pytest.approx((high - low) / (2 * step), abs=2e-2, rel=5e-2), name


def test_windows_cover_every_word_and_overlap():
    for n in range(0, 200):
        starts = list(tox.window_starts(n))
        covered = {w for s in starts for w in range(s, min(n, s + tox.WINDOW))}
        assert covered == set(range(n)) and starts[0] == 0
        assert all(b - a == tox.STRIDE < tox.WINDOW for a, b in zip(starts, starts[1:], strict=False))


def test_features_equal_a_plain_loop():
    words = [b"", b"a", b"ab", b"idiot,", "ü漢".encode(), b"..."]
    rows, grams, starts = tox.word_features(words)
    for i, word in enumerate(words):
        bare = word.strip(tox._EDGE)
        marked = b"^" + bare + b"$"
        want = [marked[k : k + 3] for k in range(len(bare))] or [b"^$^"]
        codes = [((g[0] << 16 | g[1] << 8 | g[2]) * 2654435761 >> 16) % tox.GRAM_ROWS for g in want]
        end = starts[i + 1] if i + 1 < len(words) else len(grams)
        assert grams[starts[i] : end].tolist() == codes and rows[i] == zlib.crc32(bare)


def test_score_is_the_highest_window_whatever_the_batch(params):
    text = b"all is well " * 40 + b"you are a stupid idiot and worse " + b"lovely calm day " * 50
    alone = tox.Scorer(params).scores([text])[0]
    together = tox.Scorer(params).scores([b"x y", text, None, b""])
    assert together[1] == pytest.approx(alone, abs=1e-5)
    words = tox.tokens(text)
    each = [
        tox.Scorer(params).scores([b" ".join(words[s : s + tox.WINDOW])])[0]
        for s in tox.window_starts(len(words))
    ]
    assert alone == pytest.approx(max(each), abs=1e-5)


def test_unseen_toxic_documents_are_found_and_clean_ones_left_alone(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = tox.toxicity_scores(docs, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    # One in fourteen toxic labels marks a text without any toxic word.
    assert sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.02


def test_awkward_documents(documents, awkward, spark):
    docs = documents(awkward)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (5, 0), (6, 0), (7, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")
    rows = tox.toxicity_scores(docs, labels).collect()
    assert len(rows) == len(awkward) and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert len(blank) == 1
    assert tox.toxicity_scores(documents([]), labels).collect() == []
    none = tox.toxicity_scores(docs, labels.where("false")).collect()
    assert all(r["score"] == 0 and r["predicted"] == 0 for r in none)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 0.5, "t"), (2, "b", 0.1, "u")], "doc_id bigint, text string, score double, toxic string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    kept = tox.keep_civil(docs, labels, reject_at=1.1)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))


def test_every_window_is_scored_wherever_a_passage_stands(params):
    passage = b"you are a stupid idiot and worse such a stupid mess you are a stupid idiot and worse".split()
    for before in range(40):
        words = [b"calm"] * before + passage + [b"lovely"] * (70 - before)
        found = tox.Scorer(params).scores([b" ".join(words)])[0]
        parts = [b" ".join(words[s : s + tox.WINDOW]) for s in range(len(words) - tox.WINDOW + 1)]
        assert found == pytest.approx(max(tox.Scorer(params).scores(parts)), abs=1e-5)


def min_max(values, low):
    return np.array([min(max(v, low), 1) for v in values])


def plain_logit(params, words):
    """The logit of one window by loops over its words, in double precision."""
    p = {k: np.asarray(v, np.float64) for k, v in params.items()}
    inputs = [np.concatenate(tox.project(params, tox.embed(params, tox.word_features([w])))[i:i + 1], axis=None) for w in words for i in (0, 1)]
    h = tox.HIDDEN

    def run(steps, u, c):
        state, states = np.zeros(h), []
        for x in steps:
            g = state @ u
            z, r = (min_max(0.25 * (x[k * h : (k + 1) * h] + g[k * h : (k + 1) * h]) + 0.5, 0) for k in (0, 1))
            new = min_max(x[2 * h :] + r * (g[2 * h :] + c), -1)
            state = (1 - z) * new + z * state
            states.append(state)
        return states

    ahead = run(inputs[0::2], p["u_a"], p["c_a"])
    back = run(inputs[1::2][::-1], p["u_b"], p["c_b"])[::-1]
    states = [np.concatenate(s) for s in zip(ahead, back, strict=True)]
    weights = [np.exp(np.tanh(s @ p["att_w"] + p["att_b"]) @ p["att_v"]) for s in states]
    pooled = sum(w * s for w, s in zip(weights, states, strict=True)) / sum(weights)
    return pooled @ p["out_w"] + p["out_b"][0]


def test_scores_equal_a_plain_recurrent_network(params, monkeypatch):
    monkeypatch.setattr(tox, "_BATCH_WINDOWS", 7)
    rng = np.random.default_rng(2)
    known = [b"you", b"are", b"a", b"stupid", b"calm", b"day", b"n\xc3\xa9", b"..."]
    sizes = (1, 5, 23, 24, 25, 40, 90, 24, 12)
    texts = [b" ".join(known[i] for i in rng.integers(0, len(known), n)) for n in sizes]
    found = tox.Scorer(params).scores(texts)
    for text, score in zip(texts, found, strict=True):
        words = tox.tokens(text)
        top = max(plain_logit(params, words[s : s + tox.WINDOW]) for s in tox.window_starts(len(words)))
        assert score == pytest.approx(1 / (1 + np.exp(-top)), abs=1e-5)


def test_training_windows_cover_a_text_and_begin_anywhere():
    seen = set()
    for shift in range(tox.TRAIN_STRIDE):
        for n in (0, 1, 23, 24, 25, 100):
            starts = tox._training_starts(n, shift).tolist()
            assert {w for s in starts for w in range(s, min(n, s + tox.WINDOW))} == set(range(n))
        seen.update(tox._training_starts(500, shift).tolist())
    assert seen == set(range(500 - tox.WINDOW + 1))
