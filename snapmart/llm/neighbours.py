"""The next row in a global order, without a window over all rows.

Rows are dealt to ranges of the key that hold about as many rows each, and a
window looks ahead inside a range.  The first row of every range is also sent
to the range before it, so that the last row there finds its neighbour; the
first of all rows goes to the last range, which closes the circle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ranges per shuffle partition, so that partitions get about equal shares.
RANGES_PER_PARTITION = 8
_LAST = -(2**63)


def with_next(rows: DataFrame, key: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """Adds ``next_<column>``: the values of the next row by descending key.

    Null keys come last and equal keys follow each other by descending ``tie``;
    the row after the last is the first, so a single row is its own neighbour.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    place = F.coalesce(F.col(key).cast("bigint"), F.lit(_LAST))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx(place, shares, 20 * ranges).alias("b")).first()["b"]
    bounds = F.lit(sorted(set(found or []))).cast("array<bigint>")
    ranged = rows.withColumn("_place", place).withColumn(
        "_range", F.size(F.filter(bounds, lambda b: b < F.col("_place")))
    )
    # One key per range: as many rows as there are ranges, whatever the input.
    heads = sorted(
        ranged.groupBy("_range").agg(F.max("_place").alias("head")).collect(),
        key=lambda r: r["_range"],
    )
    before = [r["_range"] for r in heads[1:]] + [r["_range"] for r in heads[:1]]
    sent = spark.createDataFrame(
        [(r["head"], to) for r, to in zip(heads, before, strict=True)],
        "_place bigint, _to int",
    )
    dealt = ranged.join(F.broadcast(sent), "_place", "left").select(
        *rows.columns,
        "_place",
        F.explode(
            F.when(
                F.col("_to").isNotNull(),
                F.array(
                    F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy")),
                    F.struct(F.col("_to").alias("range"), F.lit(True).alias("copy")),
                ),
            ).otherwise(
                F.array(F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy")))
            )
        ).alias("_at"),
    )
    ahead = Window.partitionBy("_at.range").orderBy(
        F.col("_at.copy"), F.col("_place").desc(), F.col(tie).desc()
    )
    looked = dealt.select(
        *rows.columns,
        F.col("_at.copy").alias("_copy"),
        *[F.lead(c).over(ahead).alias(f"next_{c}") for c in columns],
    )
    return looked.where(~F.col("_copy")).drop("_copy")
