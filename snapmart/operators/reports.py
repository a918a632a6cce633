"""Run reports: counts per keyword, totals, counters over categories and platforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart import settings
from snapmart.operators.merge import CHANGED, INSERTED, MATCHED, STATUS, UNTOUCHED


def counts_per_keyword(records: DataFrame, keywords: Sequence[str], column: str) -> DataFrame:
    """Records per listed keyword, 0 where nothing was found; blank keywords are skipped.

    The records are counted before the join, so both of its sides have at most
    one row per keyword.
    """
    spark = records.sparkSession
    listed = [k.strip() for k in keywords if k.strip()]
    wanted = spark.createDataFrame([(k,) for k in dict.fromkeys(listed)], f"`{column}` string")
    found = records.where(F.col(column).isin(listed)).groupBy(column).agg(F.count("*").alias("n"))
    return wanted.join(found, column, "left").select(
        column, F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def totals(records: DataFrame, key: str) -> DataFrame:
    """One row: all records and distinct records."""
    return records.agg(
        F.count("*").alias("total_records"), F.count_distinct(key).alias("distinct_records")
    )


def first_last_seen(records: DataFrame, key: str, time: str) -> DataFrame:
    """First and last observation per entity."""
    return records.groupBy(key).agg(
        F.min(time).alias("first_seen"), F.max(time).alias("last_seen")
    )


def status_by_category(merged: DataFrame, category: str) -> DataFrame:
    """Merge outcomes per category of one merge over all categories."""
    status = F.col(STATUS)
    return merged.groupBy(category).agg(
        F.count_if(status == INSERTED).alias("inserted"),
        F.count_if(status.isin(CHANGED, MATCHED)).alias("matched"),
        F.count_if(status == UNTOUCHED).alias("untouched"),
    )


def roll_up(counters: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum counters over all rows (categories, platforms)."""
    return counters.agg(*(F.sum(c).cast("bigint").alias(f"total_{c}") for c in columns))


def platform_row(platform: str, counters: DataFrame, error: str | None = None) -> DataFrame:
    """A platform's counters with its status; error texts are cut."""
    status = "SUCCESS" if error is None else f"FAILED: {error[: settings.ERROR_CHARS]}"
    return counters.select(F.lit(platform).alias("platform"), F.lit(status).alias("status"), "*")
