"""Joins on keys that may be hot, and components of a graph, all as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.tables import saved
from snapmart.operators.sizing import fits_broadcast

SALTS = 16
# Hashes of keys that are sent to all tasks, as bits.
MOST_BITS = 1 << 23
# Equal keys of these kinds have equal hashes; numbers with a zero of either sign do not.
HASHED_KINDS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType())


def look_up(
    rows: DataFrame, known: DataFrame, key: str | list[str], how: str = "left"
) -> DataFrame:
    """Join rows, of which a third may share one key, to a side with one row per key.

    The rows of a key are dealt to ``SALTS`` parts and the known side is sent to
    each, so no task gets all rows of a hot key.  The part follows from the rest
    of the row and from the partition that reads it: equal rows of different
    partitions part too, and a partition that is read again deals as before.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys] or keys
    part = F.xxhash64(*rest) + F.spark_partition_id()
    dealt = rows.withColumn("_salt", F.pmod(part, F.lit(SALTS)).cast("int"))
    spread = known.withColumn("_salt", F.explode(F.lit(list(range(SALTS)))))
    return dealt.join(spread, [*keys, "_salt"], how).drop("_salt")


def _hash_bits(marks: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(word, bits): which hashes of keys occur, 64 to a row, and the number of hashes.

    Eight times as many hashes as marks, up to ``MOST_BITS``: never more than ``MOST_BITS`` / 64 rows.
    """
    bits = 1 << 12
    while bits < min(8 * marks.count(), MOST_BITS):
        bits *= 2
    at = _hash(key, bits)
    rows = marks.select(F.shiftright(at, 6).alias("_word"), F.expr("1L").alias("one"), (at % 64).cast("int").alias("at"))
    words = rows.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(one, at)")).alias("_bits"))
    return saved(words, "mark-bits"), bits


def _hash(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def with_marks(rows: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Rows with the mark of their key, null without one.

    Marks grow with the input, so they are not sent to the driver: it gets bits of
    their hashes, of bounded size.  Rows without a bit have no mark and stay where
    they are; the others meet the marks in a shuffle, dealt to several tasks.
    """
    marks = saved(marks, "marks")
    # Without the hint marks that Spark takes for few are broadcast after all, once a salt.
    dealt = marks.hint("merge")
    kind = rows.schema[key].dataType
    bits, size = _hash_bits(marks, key)
    if kind != marks.schema[key].dataType or kind not in HASHED_KINDS or not fits_broadcast(bits):
        return look_up(rows, dealt, key)
    at = _hash(key, size)
    word = F.when(F.col(key).isNotNull(), F.shiftright(at, 6))
    asked = rows.withColumn("_word", word).join(F.broadcast(bits), "_word", "left")
    bit = F.coalesce(F.expr("shiftrightunsigned(_bits, _at) & 1"), F.lit(0))
    asked = asked.withColumn("_at", (at % 64).cast("int")).withColumn("_may", bit == 1)
    met = look_up(asked.where("_may").select(*rows.columns), dealt, key)
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in marks.schema if f.name not in rows.columns]
    return met.unionByName(asked.where("NOT _may").select(*rows.columns, *rest))


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """The smallest node (``root``) reachable from every ``node`` that has an edge.

    Each round a node takes the smallest root among its own and its
    neighbours', then the root of that root, so long chains halve.  Rounds are
    written tables; only a count of changes reaches the driver.  The neighbours
    of a node should be few; roots may have any number of nodes.
    """
    both = saved(
        edges.select(F.col(left).alias("node"), F.col(right).alias("other"))
        .union(edges.select(F.col(right).alias("node"), F.col(left).alias("other")))
        .distinct(),
        "links",
    )
    roots = saved(
        both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "roots"
    )
    while True:
        seen = both.join(roots.select(F.col("node").alias("other"), "root"), "other")
        least = (
            seen.select("node", "root")
            .union(roots.select("node", "root"))
            .groupBy("node")
            .agg(F.min("root").alias("root"))
        )
        least = saved(least, "roots")
        heads = least.join(least.select(F.col("root").alias("node")).distinct(), "node").select(
            F.col("node").alias("root"), F.col("root").alias("next")
        )
        jumped = look_up(least, heads, "root").select(
            "node", F.coalesce(F.least("next", "root"), "root").alias("root")
        )
        new = saved(jumped, "roots")
        old = roots.select("node", F.col("root").alias("old"))
        changed = new.join(old, "node").where(F.col("root") != F.col("old")).limit(1).count()
        roots = new
        if not changed:
            return roots
