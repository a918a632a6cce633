"""Temperature mixing: exponents, budgets, and the passes of every document."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import given as over
from hypothesis import strategies as st

from snapmart.llm import mixing

TOTALS = st.dictionaries(st.text("abc", max_size=3), st.integers(1, 10**9), min_size=2, max_size=8)


@over(TOTALS, st.floats(1.0, 20.0))
def test_repetition_limit_is_met(totals, limit):
    shares = mixing.plan(totals, max_repeats=limit)
    assert math.isclose(sum(s.weight for s in shares), 1)
    passes = [s.budget / s.tokens for s in shares]
    assert min(passes) >= 1 and max(s.budget - limit * s.tokens for s in shares) <= 1
    even = mixing.plan(totals, max_repeats=1e12)
    flat = [s.weight for s in even]
    if max(flat) / min(flat) < 1 + 1e-9 and max(totals.values()) / min(totals.values()) > limit:
        assert max(passes) > limit - 0.01 or min(totals.values()) < 1000


@over(TOTALS, st.floats(0.0, 1.0))
def test_target_entropy_is_met(totals, at):
    whole = sum(totals.values())
    as_is = mixing.entropy([t / whole for t in totals.values()])
    target = as_is + at * (math.log(len(totals)) - as_is)
    shares = mixing.plan(totals, target_entropy=target)
    assert mixing.entropy([s.weight for s in shares]) == pytest.approx(target, abs=1e-6)


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


def test_no_document_is_lost_and_passes_are_near_the_budget(given):
    tokens = {r["doc_id"]: len((r["text"] or "").split()) for r in given.collect()}
    source = {r["doc_id"]: r["source"] for r in given.select("doc_id", "source").collect()}
    rows = rows_of(mixing.mixed(given))
    seen = Counter(r["doc_id"] for r in rows)
    assert set(seen) == set(tokens) and max(seen.values()) <= 3
    totals = Counter()
    for d, n in tokens.items():
        totals["=" + source[d]] += n
    for share in mixing.plan(dict(totals)):
        used = sum(tokens[r["doc_id"]] for r in rows if "=" + r["source"] == share.source)
        largest = max(n for d, n in tokens.items() if "=" + source[d] == share.source)
        assert share.budget - largest < used <= share.budget
    for epoch in {r["mix_epoch"] for r in rows}:
        ids = [r["doc_id"] for r in rows if r["mix_epoch"] == epoch]
        assert len(ids) == len(set(ids))
    orders = {(r["source"], r["mix_epoch"], r["mix_block"]): r["mix_order"] for r in rows}
    for r in rows:
        assert orders[r["source"], r["mix_epoch"], r["mix_block"]] == r["mix_order"]


def test_budget_of_all_tokens(given):
    tokens = {r["doc_id"]: len((r["text"] or "").split()) for r in given.collect()}
    rows = rows_of(mixing.mixed(given, budget_share=0.5))
    used = sum(tokens[r["doc_id"]] for r in rows)
    assert used <= 0.5 * sum(tokens.values()) + 20
    assert used > 0.3 * sum(tokens.values())


def test_awkward_documents(documents, awkward):
    rows = rows_of(mixing.mixed(documents(awkward), max_repeats=3.0))
    seen = Counter((r["doc_id"], r["text"]) for r in rows)
    want = Counter((r[0], r[1]) for r in awkward)
    assert set(seen) == set(want)
    assert all(seen[k] % want[k] == 0 for k in want)
    assert rows_of(mixing.mixed(documents([]))) == []
    empty = rows_of(mixing.mixed(documents([(1, None), (2, "")])))
    assert sorted(r["doc_id"] for r in empty) == [1, 2]


def test_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, "a b", "s", 5, 6)], "doc_id int, text string, source string, mix_epoch int, weight int"
    )
    (row,) = rows_of(mixing.mixed(frame).drop("weight"))
    assert row["mix_epoch"] == 0 and row["mix_weight"] == 1.0
