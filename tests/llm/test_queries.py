"""The registered queries: their columns, their rows, and plans without Python where asked."""

from __future__ import annotations

import zlib

import pytest

import __spark_entry__ as contract
from snapmart.llm import hidden_markov, queries, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3_lm_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_line_dedup": "doc_id text",
    "op7_simhash": "doc_id fingerprint component_id",
    "op8_quality_classifier": "doc_id log_weight gumbel_key kept",
    "op9_pieces": "doc_id n_ids ids decoded_sha256 round_trip",
    "op10_mixing": "doc_id source mix_weight mix_epoch mix_block mix_order",
    "op11_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_token_counts": "doc_id n_bytes n_tokens over_limit",
    "pipeline": "doc_id text lang source n_chars ids round_trip",
}


def test_every_operator_has_one_query():
    assert set(COLUMNS) == set(queries.QUERIES) | {"pipeline"}
    assert set(COLUMNS) <= set(contract.queries())
    numbers = sorted(int(n.removeprefix("op").split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - {"op10_mixing", "pipeline"}))
def test_one_row_for_each_document(spark, given, name):
    frame = contract.queries()[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(frame.columns)
    ids = sorted(r["doc_id"] for r in frame.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in given.select("doc_id").collect())


@pytest.mark.parametrize("name", ["op1_fingerprints", "op2_secrets", "op5_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan


def test_folds_are_those_of_the_contract(spark):
    scored = contract.queries()["op3_lm_scores"](spark, SF).select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in scored)
    assert hidden_markov.HELD_OUT == (7, 2) and toxicity.HELD_OUT == (3, 1)
    toxic = contract.queries()["op4_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in toxic)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in toxic)
