"""The hidden Markov model against plain counts and a plain forward recursion."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from snapmart.llm import hidden_markov as hm


def plain_tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_rows(rows):
    counts = Counter(t for i, text in rows if not held(i) for t in plain_tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = plain_tokens(text)
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((i, held(i), len(own), sum(counts[t] > 0 for t in own), n, score))
    return out


def compare(frame, rows):
    got = sorted((tuple(r) for r in frame.collect()), key=repr)
    want = sorted(base_rows(rows), key=repr)
    assert len(got) == len(want)
    assert Counter((*r[:5], round(r[5], 6)) for r in got) == Counter((*r[:5], round(r[5], 6)) for r in want)
    assert all(math.isfinite(r[6]) and r[6] <= 1e-9 for r in got)
    return got


def test_base_scores_of_given_documents(given):
    rows = [tuple(r) for r in given.select("doc_id", "text").collect()]
    frame = hm.scores(given)
    assert frame.columns == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ]
    got = compare(frame, rows)
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])


def test_rare_tokens_are_joined(given, monkeypatch):
    monkeypatch.setattr(hm, "FREQUENT", 200)
    rows = [tuple(r) for r in given.select("doc_id", "text").collect()]
    got = compare(hm.scores(given), rows)
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])


def test_awkward_documents(documents, awkward):
    compare(hm.scores(documents(awkward)), [(r[0], r[1]) for r in awkward])
    assert hm.scores(documents([])).collect() == []
    only_held = next(i for i in range(100) if held(i))
    (row,) = hm.scores(documents([(only_held, "a b")])).collect()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and row["base_score"] == 0


def random_model(rng, size):
    part = lambda *s: rng.dirichlet(np.ones(s[-1]), s[:-1])
    return hm.Model(part(hm.STATES), part(hm.STATES), part(hm.STATES, hm.STATES), part(hm.STATES, size).T)


def lists(sequences):
    return pa.array([np.array(s, np.int32) for s in sequences], pa.list_(pa.int32()))


def test_forward_recursion_is_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    model = random_model(rng, 5)
    sequences = [rng.integers(0, 5, n).tolist() for n in (1, 2, 3, 4, 3)]
    got = hm.log_likelihoods(model, lists(sequences))
    for sequence, found in zip(sequences, got, strict=True):
        total = 0.0
        for path in np.ndindex(*[hm.STATES] * len(sequence)):
            p = model.start[path[0]] * model.emissions[sequence[0], path[0]]
            for t in range(1, len(sequence)):
                p *= model.moves[path[t - 1], path[t]] * model.emissions[sequence[t], path[t]]
            total += p
        assert found == pytest.approx(math.log(total))


def test_likelihoods_of_all_short_sequences_add_up_to_one():
    model = random_model(np.random.default_rng(1), 3)
    every = [list(s) for s in np.ndindex(3, 3, 3)]
    assert np.exp(hm.log_likelihoods(model, lists(every))).sum() == pytest.approx(1)


def test_long_sequences_do_not_underflow():
    model = random_model(np.random.default_rng(2), 50)
    rng = np.random.default_rng(3)
    found = hm.log_likelihoods(model, lists([rng.integers(0, 50, 20_000), [1]]))
    assert -200_000 < found[0] < -20_000


def test_block_counts_equal_counts_of_all_paths():
    rng = np.random.default_rng(4)
    model = random_model(rng, 4)
    blocks, sizes = np.array([[0, 3], [2, 1], [1, 0]]), np.array([3, 2])
    emit, moves, start, log_likelihood = hm.block_counts(model, blocks, sizes, np.array([True, False]))
    want_emit, want_moves, want_start, logs = np.zeros((4, 8)), np.zeros((8, 8)), np.zeros(8), 0.0
    for b in range(2):
        sequence = blocks[: sizes[b], b]
        begin = model.start if b == 0 else model.middle
        weights = {}
        for path in np.ndindex(*[hm.STATES] * len(sequence)):
            p = begin[path[0]] * model.emissions[sequence[0], path[0]]
            for t in range(1, len(sequence)):
                p *= model.moves[path[t - 1], path[t]] * model.emissions[sequence[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        logs += math.log(total)
        for path, p in weights.items():
            for t, s in enumerate(path):
                want_emit[sequence[t], s] += p / total
                if t:
                    want_moves[path[t - 1], s] += p / total
            if b == 0:
                want_start[path[0]] += p / total
    assert np.allclose(emit, want_emit) and np.allclose(moves, want_moves)
    assert np.allclose(start, want_start) and log_likelihood == pytest.approx(logs)


def test_training_raises_the_likelihood(spark, given):
    counts = hm.token_counts(given)
    lexicon = hm.Lexicon.of(counts)
    folded = given.selectExpr("doc_id", "false AS held_out", "text")
    rows = hm.encoded(folded, spark.sparkContext.broadcast(lexicon)).cache()
    _, history = hm.train(rows, lexicon.counts, rounds=4)
    assert history == sorted(history) and history[-1] > history[0]
    # Blocks are all tokens: the counts of one round add up to them.
    counted, _ = hm.expected_counts(rows, hm.Model.begin(lexicon.counts))
    assert counted["emit"].sum() == pytest.approx(lexicon.total)
    assert np.allclose(counted["emit"].sum(axis=1), lexicon.counts)
