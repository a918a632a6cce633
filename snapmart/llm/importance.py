"""Quality classification by importance resampling.

Two generative models over hashed words and word pairs, one of trusted target
documents and one of all raw documents, give each document the logarithm of its
importance weight: the sum over its n-grams of log(target share / raw share).
Drawing documents without replacement in proportion to these weights is keeping
the largest of log weight + Gumbel noise (Gumbel top-k).

The models have a fixed number of buckets.  The k-th largest key is found by
counting keys in ever narrower bins, so keys are never sorted or gathered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.links import with_marks
from snapmart.llm.tables import saved
from snapmart.llm.texts import whole_text

BUCKETS = 1 << 16
# Each target share starts from the raw one, as if seen so many times as often as expected.
PRIOR_COUNT = 10.0
BINS = 1024


def buckets(text: bytes | None) -> np.ndarray:
    """Buckets of a text's words, then of its pairs of neighbouring words."""
    words = (text or b"").split()
    hashed = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    pairs = (hashed[:-1] * 31 + hashed[1:]) * 2654435761 >> 13
    return np.concatenate([hashed % BUCKETS, pairs % BUCKETS])


def counts(docs: DataFrame, target_ids: DataFrame, key: str, text: str) -> np.ndarray:
    """Two rows of bucket counts: of target documents and of all documents."""
    marks = target_ids.select(key).where(F.col(key).isNotNull()).distinct()
    marks = marks.withColumn("_target", F.lit(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for value, target in zip(texts, batch.column(1), strict=True):
                own = np.bincount(buckets(value.as_py()), minlength=BUCKETS)
                found[1] += own
                if target.is_valid:
                    found[0] += own
        used = np.flatnonzero(found[1])
        columns = [pa.array(x) for x in (used, found[0, used], found[1, used])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "target", "raw"])

    rows = (
        with_marks(docs.select(key, text), marks, key)
        .select(text, "_target")
        .mapInArrow(run, "bucket bigint, target bigint, raw bigint")
        .groupBy("bucket")
        .agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
        .collect()  # at most one row per bucket
    )
    total = np.zeros((2, BUCKETS))
    for r in rows:
        total[:, r["bucket"]] = r["target"], r["raw"]
    return total


def log_ratios(total: np.ndarray) -> np.ndarray:
    """log(target share / raw share) per bucket; 0 everywhere without target documents."""
    target, raw = total
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = target.sum() * raw / raw.sum()
    return np.log((target + PRIOR_COUNT) / (expected + PRIOR_COUNT))


def with_log_weights(docs: DataFrame, ratios: np.ndarray, key: str, text: str) -> DataFrame:
    """``key``, ``n_grams``, ``log_weight`` and ``gumbel_key`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            grams = [buckets(t.as_py()) for t in texts]
            sums = np.array([shared.value[g].sum() for g in grams], np.float64)
            sizes = np.array([len(g) for g in grams], np.int64)
            noise = np.array(batch.column(1).to_numpy(), np.float64)
            noisy = sums - np.log(-np.log(noise))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (sizes, sums, noisy))],
                ["key", "n_grams", "log_weight", "gumbel_key"],
            )

    # A fixed uniform number in (0, 1) for each id and text, so a rerun draws the same.
    drawn = F.shiftrightunsigned(F.xxhash64(F.col(key), whole_text(text), F.lit("draw")), 11)
    uniform = (drawn.cast("double") + 0.5) / float(1 << 53)
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), uniform.alias("u"), F.col(text).alias("text"))
    return named.mapInArrow(
        run, f"key {kind}, n_grams bigint, log_weight double, gumbel_key double"
    ).withColumnRenamed("key", key)


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by counting values in bins of the range that holds it."""
    span = keys.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high, above = span["low"], span["high"], 0
    while low < high:
        width = (high - low) / BINS
        if low + width <= low:
            # Neighbouring numbers: take the upper one if it is enough.
            upper = keys.where(F.col(column) >= high).count()
            return high if upper >= k else low
        inside = keys.where((F.col(column) >= low) & (F.col(column) <= high))
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1))
        rows = (
            inside.groupBy(at.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .collect()
        )
        for r in sorted(rows, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


def good_share(labels: DataFrame) -> float:
    """Share of labelled documents that are good, at the upper end of its standard error."""
    row = labels.where("quality IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("quality").cast("double")).alias("p")
    ).first()
    if not row["n"]:
        return 1.0
    return min(1.0, row["p"] + 2 * math.sqrt(row["p"] * (1 - row["p"]) / row["n"]))


def resample(
    docs: DataFrame, target_ids: DataFrame, share: float, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Weights and ``kept`` of every row; kept are the top ``share`` of all Gumbel keys.

    Null, empty and blank texts have no n-grams and a weight of 1.  Repeated
    rows draw the same number and stay or go together; with such a tie at the
    end more than the share is kept.  Without target documents all weights are
    1.  An empty table gives no rows; other columns are ignored.
    """
    ratios = log_ratios(counts(docs, target_ids, key, text))
    scored = saved(with_log_weights(docs, ratios, key, text), "importance")
    n = scored.count()
    k = min(n, math.ceil(n * share))
    if k == 0:
        return scored.withColumn("kept", F.lit(False))
    least = kth_largest(scored, "gumbel_key", k)
    return scored.withColumn("kept", F.col("gumbel_key") >= F.lit(least))
