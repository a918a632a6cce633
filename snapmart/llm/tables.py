"""Reading the given tables and writing intermediates that survive a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapmart.workspace import new_folder

# Columns of ``documents``, the rows every pipeline stage passes on.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written below the shared folder and read back: its lineage ends here."""
    spark = frame.sparkSession
    folder = new_folder(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)
