"""The queries of the dealt operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import (
    checks,
    fill_in_middle,
    fingerprints,
    hidden_markov,
    importance,
    line_dedup,
    merkle,
    mixing,
    pieces,
    quality_rules,
    secrets,
    simhash,
    token_counts,
    toxicity,
)
from snapmart.llm.tables import table
from snapmart.llm.texts import whole_text

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of documents and their edited texts."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: fixed patterns and high-entropy windows."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and hidden Markov score of every document."""
    return hidden_markov.scores(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fold."""
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document, against those labelled good."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.judged(table(spark, sf_dir, "documents"), trusted)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that repeat earlier ones."""
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "text",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint").alias("n_lines"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.hex_text("fp").alias("fingerprint"), "component_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, Gumbel key and verdict of every document.

    As many documents are kept as the labels say are good.
    """
    labels = table(spark, sf_dir, "labels")
    return importance.resample(
        table(spark, sf_dir, "documents"),
        labels.where("quality = 1"),
        importance.good_share(labels),
    )


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.encoded_and_decoded(docs)
    return both.select(
        "doc_id",
        F.size("ids").alias("n_ids"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pass of every document in a mixture that repeats no source more than twice.

    The budget is the smallest that loses no document.
    """
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "mix_weight", "mix_epoch", "mix_block", "mix_order"
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's transformed and rebuilt text."""
    made = fill_in_middle.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return fill_in_middle.restored(made).select(
        "doc_id",
        F.col("fim_tokens").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_output", 256).alias("output_sha256"),
        F.sha2("fim_restored", 256).alias("restored_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document against the manifest, and whether a tampered one passes."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    made = merkle.verified_documents(table(spark, sf_dir, "documents"), tampered)
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(F.flatten("proof.others"), ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens exceed the limit."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.octet_length(whole_text("text")).cast("bigint").alias("n_bytes")
    )
    return token_counts.token_counts(docs, carried=("doc_id", "n_bytes")).withColumn(
        "over_limit", F.col("n_tokens") > token_counts.LIMIT
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_secrets,
        op3_lm_scores,
        op4_toxicity,
        op5_quality_rules,
        op6_line_dedup,
        op7_simhash,
        op8_quality_classifier,
        op9_pieces,
        op10_mixing,
        op11_fill_in_middle,
        op12_merkle_manifest,
        op13_token_counts,
    )
}
# The others use hashes, models or folds without a twin in SQL: see tests/llm for brute force.
CHECKS: dict[str, str] = checks.CHECKS
