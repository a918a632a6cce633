"""Tables in hash buckets, with a manifest for every version.

A row lies in the bucket of its key's hash.  A version is a small manifest that
names the folders of each bucket; writing a version adds folders for the buckets
it changes and takes the others over from the version before, whose files both
share.  The manifest is written last, so a write that breaks off leaves the
old version in place, and readers keep the files of the one they opened.

``buckets`` is chosen for the table once, so that a bucket is a fair task.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"
BUCKETS = 64
# Folders of a bucket from which an added one makes it be written anew.
MOST_PARTS = 8
_MANIFEST = "parts bigint, bucket int, folder string"


@dataclass(frozen=True)
class Manifest:
    """One version: how many buckets there are, and the folders of each that has rows."""

    version: int
    buckets: int
    parts: tuple[tuple[int, str], ...] = ()

    def of(self, wanted: Iterable[int]) -> list[tuple[int, str]]:
        """The parts of some buckets."""
        chosen = set(wanted)
        return [p for p in self.parts if p[0] in chosen]


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def _removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _versions(spark: SparkSession, root: str) -> list[int]:
    found = _listed(spark, f"{root}/manifests")
    return sorted(int(n.removeprefix("v=")) for n in found if n.startswith("v="))


def read_manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    """The manifest of one version."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/v={version}").collect()
    parts = sorted((r["bucket"], r["folder"]) for r in rows if r["bucket"] is not None)
    return Manifest(version, rows[0]["parts"], tuple(parts))


def latest_manifest(spark: SparkSession, root: str, at_most: int | None = None) -> Manifest | None:
    """The newest finished version (not beyond ``at_most``), or None."""
    for version in reversed(_versions(spark, root)):
        if at_most is not None and version > at_most:
            continue
        if "_SUCCESS" in _listed(spark, f"{root}/manifests/v={version}"):
            return read_manifest(spark, root, version)
    return None


def write_manifest(spark: SparkSession, root: str, made: Manifest) -> None:
    """Finish a version; written again, it replaces itself."""
    rows = [(made.buckets, None, None), *((made.buckets, b, f) for b, f in made.parts)]
    frame = spark.createDataFrame(rows, _MANIFEST)
    frame.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/v={made.version}")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row by the hash of its key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_hit(frame: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """The buckets that rows fall into: as many numbers as there are buckets, at most."""
    found = frame.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()
    return sorted(r[BUCKET] for r in found)


def read_parts(
    spark: SparkSession, root: str, parts: Iterable[tuple[int, str]], schema: T.StructType
) -> DataFrame:
    """The rows of some parts; no other file is opened."""
    paths = [f"{root}/data/{folder}/{BUCKET}={bucket}" for bucket, folder in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_parts(
    frame: DataFrame, root: str, keys: Sequence[str], buckets: int
) -> list[tuple[int, str]]:
    """Write rows into a new folder by bucket; the parts belong to no version yet."""
    folder = uuid.uuid4().hex
    placed = frame.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", F.col(BUCKET))
    placed.write.partitionBy(BUCKET).parquet(f"{root}/data/{folder}")
    made = (n for n in _listed(frame.sparkSession, f"{root}/data/{folder}") if n.startswith(f"{BUCKET}="))
    return sorted((int(n.removeprefix(f"{BUCKET}=")), folder) for n in made)


def replace_buckets(
    frame: DataFrame, root: str, keys: Sequence[str], base: Manifest, hit: Iterable[int], version: int
) -> Manifest:
    """A version in which the rows are all that the hit buckets hold."""
    gone = set(hit)
    kept = [p for p in base.parts if p[0] not in gone]
    parts = sorted([*kept, *write_parts(frame, root, keys, base.buckets)])
    made = Manifest(version, base.buckets, tuple(parts))
    write_manifest(frame.sparkSession, root, made)
    return made


def add_rows(
    frame: DataFrame,
    root: str,
    keys: Sequence[str],
    base: Manifest,
    version: int,
    fold: Callable[[DataFrame], DataFrame] | None = None,
) -> Manifest:
    """A version with the rows added; buckets of many folders are brought into one.

    So a bucket never has more than ``MOST_PARTS`` folders, however many versions
    there were, and most versions write little more than the rows they add.
    ``fold`` reduces the rows of a bucket when that happens (to one a key, say).
    """
    spark = frame.sparkSession
    parts = [*base.parts, *write_parts(frame, root, keys, base.buckets)]
    count = Counter(bucket for bucket, _ in parts)
    full = {bucket for bucket, n in count.items() if n > MOST_PARTS}
    if full:
        old = [p for p in parts if p[0] in full]
        rows = read_parts(spark, root, old, frame.schema)
        merged = write_parts(fold(rows) if fold else rows, root, keys, base.buckets)
        parts = [*(p for p in parts if p[0] not in full), *merged]
    made = Manifest(version, base.buckets, tuple(sorted(parts)))
    write_manifest(spark, root, made)
    return made


def expire(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Remove all but the newest finished versions, and the folders no kept one names.

    Not to be run while a version is being written or an old one read.
    """
    finished = [
        v for v in _versions(spark, root) if "_SUCCESS" in _listed(spark, f"{root}/manifests/v={v}")
    ]
    kept = finished[len(finished) - keep :]
    used = {folder for v in kept for _, folder in read_manifest(spark, root, v).parts}
    for version in set(_versions(spark, root)) - set(kept):
        _removed(spark, f"{root}/manifests/v={version}")
    for folder in set(_listed(spark, f"{root}/data")) - used:
        _removed(spark, f"{root}/data/{folder}")
