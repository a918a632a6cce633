"""The corpus pipeline: stages over ``documents``, each applying one operator of ``llm``.

Every stage works on all rows its predecessor kept.  Nulls, empty and very long
texts, repeated rows, empty tables and extra columns are treated as the
operators say; extra columns pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import line_dedup, mixing, pieces, simhash, toxicity
from snapmart.llm.tables import saved, table


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network trained on the labels does not reject."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def without_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose runs of lines that repeat earlier ones are deleted."""
    return line_dedup.dedup_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources takes them, each at least once."""
    return mixing.mixed(docs).select(*docs.columns)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, decoded again to see that nothing is lost."""
    both = pieces.encoded_and_decoded(docs)
    return both.withColumn("round_trip", F.col("decoded").eqNullSafe(F.col("text"))).drop("decoded")


STAGES = [
    ("toxicity", civil),
    ("line_dedup", without_repeated_runs),
    ("simhash", one_of_each_group),
    ("mixing", mixture),
    ("pieces", in_pieces),
]
# Networks, folds over lines and merges of pieces have no SQL twin: tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
