"""Quality rules: base counts, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed words and word pairs are counted: one from trusted
documents (labelled quality 1), one from all documents.  A document's verdict
is the sum over its n-grams of log(trusted share / raw share), divided by their
number, against a fixed threshold; every document gets one.

Texts are split once.  What the two later passes need of a text is written as
one small number per word, below the shared folder; the multinomials have a
fixed number of buckets, so they travel as one constant array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.links import with_marks
from snapmart.llm.tables import saved
from snapmart.llm.texts import SPACE, constant_doubles, whole_text, words

BUCKETS = 1 << 16
# Each trusted share starts from the raw one, as if seen so many times as often as expected.
# Rare n-grams, which say little, stay near a ratio of 1 that way.
PRIOR_COUNT = 10.0
# Least mean log-likelihood ratio per n-gram that a document is kept with.
THRESHOLD = -0.125
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
# FIXED VALUES: characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts and ``_words``, the hash of each word in order.

    Null and empty texts count 0 everywhere.
    """
    carried = docs.columns
    body = whole_text(text)
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    split = docs.select(*carried, words(body).alias("_split"), lines.alias("_lines"))
    hashed = split.select(
        *carried,
        F.size("_split").cast("bigint").alias("n_words"),
        F.length(F.array_join("_split", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_split", lambda w: F.xxhash64(w)).alias("_words"),
    )
    last = F.size("_words") - REPEAT_WINDOW
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(REPEAT_WINDOW)]),
    )
    # Windows sorted by hash: those equal to a neighbour occur twice or more.
    placed = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    repeated = F.filter(
        "_placed",
        lambda x, k: F.coalesce(F.get("_placed", k - 1)["w"] == x["w"], F.lit(False))
        | F.coalesce(F.get("_placed", k + 1)["w"] == x["w"], F.lit(False)),
    )
    covered = F.transform(
        "_starts",
        lambda p, k: F.least(
            F.lit(REPEAT_WINDOW), F.coalesce(F.get("_starts", k + 1) - p, F.lit(REPEAT_WINDOW))
        ),
    )
    none = F.array().cast("array<struct<w:bigint,i:int>>")
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return (
        hashed.withColumn(
            "_windows", F.when(last >= 1, windows).otherwise(F.array().cast("array<bigint>"))
        )
        .withColumn("_placed", F.when(some, placed).otherwise(none))
        .withColumn("_starts", F.sort_array(F.transform(repeated, lambda x: x["i"])))
        .withColumn("n_repeat_words", _sum(covered).cast("bigint"))
        .drop("_windows", "_placed", "_starts")
    )


def _pairs(ids: str) -> Column:
    """The bucket of each pair of neighbouring words, from the buckets of the words."""
    n = F.size(ids)
    return F.zip_with(
        F.slice(ids, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(ids, F.lit(2), F.greatest(n - 1, F.lit(0))),
        _pair,
    )


def _pair(left: Column, right: Column) -> Column:
    return F.pmod(F.xxhash64(left, right), F.lit(BUCKETS)).cast("int")


def log_ratios(counted: DataFrame, trusted_ids: DataFrame, key: str) -> list[float]:
    """log(trusted share / raw share) of every bucket, 0 everywhere without trusted documents.

    ``counted`` has the key and ``_ids``; the result has one number per bucket.
    """
    marks = trusted_ids.select(key).where(F.col(key).isNotNull()).distinct()
    marks = marks.withColumn("_trusted", F.lit(1))
    rows = (
        with_marks(counted.select(key, "_ids"), marks, key)
        .select(F.explode(F.concat("_ids", _pairs("_ids"))).alias("bucket"), "_trusted")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("trusted"))
        .collect()  # at most one row per bucket
    )
    raw = sum(r["raw"] for r in rows)
    trusted = sum(r["trusted"] for r in rows)
    ratios = [0.0] * BUCKETS
    if trusted:
        for r in rows:
            expected = trusted * r["raw"] / raw
            ratios[r["bucket"]] = math.log(
                (r["trusted"] + PRIOR_COUNT) / (expected + PRIOR_COUNT)
            )
    return ratios


def mean_ratio(ids: str, ratios: list[float]) -> Column:
    """Sum of the log ratios of a document's n-grams over their number; 0 without words."""
    table = constant_doubles(ratios)
    folded = F.aggregate(
        ids,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda s, u: F.struct(
            u.alias("last"),
            (
                s["sum"]
                + F.get(table, u)
                + F.when(s["last"] >= 0, F.get(table, _pair(s["last"], u))).otherwise(0.0)
            ).alias("sum"),
        ),
        lambda s: s["sum"],
    )
    return F.when(F.size(ids) == 0, F.lit(0.0)).otherwise(folded / (2 * F.size(ids) - 1))


def judged(
    docs: DataFrame, trusted_ids: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD
) -> DataFrame:
    """Base counts, ``base_failed``, ``mean_ratio`` and ``kept`` of every document.

    ``trusted_ids`` holds keys of trusted documents; null keys and keys without
    a document are ignored, repeated ones count once.  Repeated documents are
    judged each.  Null and empty texts fail the base rule.  An empty table
    gives no rows.  Other columns of the documents are ignored.
    """
    counts = base_counts(docs.select(key, "text")).drop("text")
    bucket = F.transform("_words", lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    counted = saved(counts.withColumn("_ids", bucket).drop("_words"), "quality-words")
    ratios = log_ratios(counted, trusted_ids, key)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    scored = counted.withColumn("base_failed", failed).withColumn(
        "mean_ratio", mean_ratio("_ids", ratios)
    )
    return scored.drop("_ids").withColumn(
        "kept", ~F.col("base_failed") & (F.col("mean_ratio") >= threshold)
    )
