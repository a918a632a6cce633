"""Tables and folders: namespaces, append-only history, versioned masters, exports."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_COLUMN = "crawl_day"
_VERSION = "upto="
_FINISHED = "finished"


def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    """One catalog namespace per platform, stored below a shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Remove a namespace with its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def table(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """A table of a platform's namespace."""
    return spark.table(f"`{namespace}`.`{name}`")


def save_table(frame: DataFrame, namespace: str, name: str, mode: str = "overwrite") -> None:
    """Save a frame as a Parquet table of a namespace."""
    frame.write.mode(mode).format("parquet").saveAsTable(f"`{namespace}`.`{name}`")


def save_bucketed_master(
    frame: DataFrame, namespace: str, name: str, key: str, buckets: int
) -> None:
    """A master bucketed and sorted by key: merges on the key do not reshuffle it."""
    (
        frame.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(f"`{namespace}`.`{name}`")
    )


def append_history(frame: DataFrame, path: str, moment: str, regroup: bool = True) -> None:
    """Append every observation, repeats included, partitioned by its day.

    ``regroup`` brings a day's rows together for few, large files; the rebalance
    hint lets AQE split a day that is much larger than the others.  Without it
    nothing is shuffled and each task writes a file per day it holds.
    """
    dated = frame.withColumn(DAY_COLUMN, F.col(moment).cast("date"))
    if regroup:
        dated = dated.hint("rebalance", F.col(DAY_COLUMN))
    dated.write.mode("append").partitionBy(DAY_COLUMN).parquet(path)


def write_history_batch(
    frame: DataFrame, path: str, batch_id: int, moment: str | None = None
) -> None:
    """History of one streaming batch; writing the same batch again replaces it.

    With ``moment`` the batch's rows are partitioned by their day.
    """
    writer = frame.write.mode("overwrite")
    if moment is not None:
        dated = frame.withColumn(DAY_COLUMN, F.col(moment).cast("date"))
        writer = dated.write.mode("overwrite").partitionBy(DAY_COLUMN)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_history(
    spark: SparkSession, path: str, moment: str, since: str | datetime | None = None
) -> DataFrame:
    """History partitioned by day, from a moment on; days before it are not listed or opened."""
    history = spark.read.parquet(path)
    if since is None:
        return history
    bound = F.lit(since).cast("timestamp_ntz")
    return history.where(
        (F.col(DAY_COLUMN) >= bound.cast("date")) & (F.col(moment).cast("timestamp_ntz") >= bound)
    )


def append_rows(frame: DataFrame, path: str) -> None:
    """Append to a plain folder (quarantine)."""
    frame.write.mode("append").parquet(path)


def export_json(frame: DataFrame, path: str) -> None:
    """JSON Lines in UTF-8, written in parallel."""
    frame.write.mode("overwrite").json(path)


def read_if_any(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The Parquet folder at a path, or None when there is none yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_version(spark: SparkSession, root: str, at_most: int | None = None) -> int | None:
    """Newest finished master version (not beyond ``at_most``), or None.

    Finished versions are listed in a small table beside them, so one row comes
    to the driver however many there are.
    """
    finished = read_if_any(spark, f"{root}/{_FINISHED}")
    if finished is None:
        return None
    if at_most is not None:
        finished = finished.where(F.col("version") <= at_most)
    return finished.agg(F.max("version").alias("version")).first()["version"]


def write_version(frame: DataFrame, root: str, version: int) -> None:
    """Write a master version into its own folder; readers keep the one they opened."""
    frame.write.mode("overwrite").parquet(f"{root}/{_VERSION}{version}")
    listed = frame.sparkSession.createDataFrame([(version,)], "version bigint")
    listed.coalesce(1).write.mode("append").parquet(f"{root}/{_FINISHED}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Read one master version."""
    return spark.read.parquet(f"{root}/{_VERSION}{version}")


def purge_null_keys(frame: DataFrame, key: str) -> DataFrame:
    """Rows whose key is present."""
    return frame.where(F.col(key).isNotNull())


def purged_count(frame: DataFrame, key: str) -> DataFrame:
    """How many rows :func:`purge_null_keys` removes, as a one-row frame."""
    return frame.agg(F.count_if(F.col(key).isNull()).alias("deleted"))


def has_key(frame: DataFrame, key: str) -> Column:
    """The key is present and neither an empty text nor the number zero."""
    column = F.col(key)
    if isinstance(frame.schema[key].dataType, T.StringType):
        return column.isNotNull() & (column != "")
    return column.isNotNull() & (column != 0)
