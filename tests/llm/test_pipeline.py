"""The pipeline, stage by stage, against the brute-force versions of its operators."""

from __future__ import annotations

from collections import Counter

import pytest
import sentencepiece
from test_line_dedup import plain as plain_lines
from test_simhash import groups, plain

import corpus_pipeline
from snapmart.llm import pieces, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def staged(spark, docs):
    """The rows before and after each stage."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return out


@pytest.fixture(scope="module")
def stages(spark):
    return {n: (b.collect(), a.collect()) for n, b, a in staged(spark, spark.read.parquet(f"{SF}/documents.parquet"))}


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "pieces"]


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.createDataFrame(before)
    params = toxicity.train(*toxicity.labelled_sample(docs, labels))
    scores = toxicity.Scorer(params).scores((r["text"] or "").encode() for r in before)
    far = [(r, s) for r, s in zip(before, scores, strict=True) if abs(s - toxicity.REJECT_AT) > 1e-3]
    kept = {r["doc_id"] for r in after}
    assert all((r["doc_id"] in kept) == (s < toxicity.REJECT_AT) for r, s in far)
    assert set(after) <= set(before)


def test_line_dedup_stage(stages):
    before, after = stages["line_dedup"]
    want = plain_lines([(r["doc_id"], r["text"]) for r in before], 50)
    assert {r["doc_id"]: r["text"] for r in after} == {before[i]["doc_id"]: t for i, t in want.items()}


def test_simhash_stage(stages):
    before, after = stages["simhash"]
    ids = [r["doc_id"] for r in before]
    want = set(groups([plain(r["text"]) for r in before], ids))
    assert sorted(r["doc_id"] for r in after) == sorted(want) and set(after) <= set(before)


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    assert set(after) == set(before) and max(Counter(after).values()) <= 3


def test_pieces_stage(stages):
    before, after = stages["pieces"]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    assert Counter((r["doc_id"], r["text"]) for r in before) == Counter((r["doc_id"], r["text"]) for r in after)
    assert all(r["ids"] == library.encode(r["text"]) and r["round_trip"] for r in after)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == [*COLUMNS, "ids", "round_trip"]
    assert Counter(r["doc_id"] for r in rows.collect()) == Counter(r["doc_id"] for r in stages["pieces"][1])


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_and_extra_rows_pass_every_stage(spark, documents, awkward, empty):
    docs = documents([] if empty else awkward).selectExpr("*", "1 AS fp", "'x' AS score", "2L AS row")
    rows = None
    for name, before, after in staged(spark, docs):
        want = before.columns if name != "pieces" else [*before.columns, "ids", "round_trip"]
        rows = after.collect()
        assert after.columns == want
    assert bool(rows) != empty
    if not empty:
        assert {r["doc_id"] for r in rows} >= {1, 5, 6, 7}
