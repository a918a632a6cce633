"""Mixing sources to target weights.

Temperature mixing raises each source's token share to an exponent and
normalises.  The exponent is found by bisection: the one whose weights have a
target entropy, or the smallest that repeats no source more than a limit.  The
weights are realised as a token budget per source.  A source passes as often as
its budget allows; each pass runs through its blocks of documents in another
permutation, and the last one stops where the budget is used up: after whole
blocks, then after single documents of the block at the edge.

Blocks are hash ranges of a source, so a hot source is dealt to many tasks.  One
number per source reaches the driver; the plan has one row per source and block.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.tables import saved
from snapmart.llm.texts import whole_text, words
from snapmart.operators.sizing import fits_broadcast

BLOCKS = 1024
MAX_REPEATS = 2.0
_STEPS = 60


@dataclass(frozen=True)
class Share:
    """What one source gets: its weight, its token budget, and its passes."""

    source: str
    tokens: int
    weight: float
    budget: int

    @property
    def full_passes(self) -> int:
        return self.budget // self.tokens if self.tokens else 1

    @property
    def left(self) -> int:
        """Tokens of the budget after the full passes."""
        return self.budget % self.tokens if self.tokens else 0


def weights(shares: list[float], exponent: float) -> list[float]:
    """Token shares raised to an exponent, normalised; sources without tokens get none."""
    raised = [s**exponent if s > 0 else 0.0 for s in shares]
    total = math.fsum(raised)
    return [r / total for r in raised]


def entropy(parts: list[float]) -> float:
    """Shannon entropy in nats."""
    return -math.fsum(p * math.log(p) for p in parts if p > 0)


def repeats(shares: list[float], parts: list[float]) -> float:
    """How often the most repeated source passes while the least repeated passes once."""
    ratios = [w / s for s, w in zip(shares, parts, strict=True) if s > 0]
    return max(ratios) / min(ratios)


def bisect_exponent(meets: Callable[[float], bool], low: float = 0.0, high: float = 1.0) -> float:
    """The smallest exponent that meets a condition which holds from some point on."""
    if meets(low):
        return low
    for _ in range(_STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if meets(middle) else (middle, high)
    return high


def plan(
    totals: dict[str, int],
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
) -> list[Share]:
    """Weights and budgets of sources with given token totals.

    With ``target_entropy`` (nats) the exponent gives weights of that entropy,
    or the nearest between the shares as they are and equal weights; otherwise
    the flattest weights are taken at which no source passes more than
    ``max_repeats`` times as often as another.  Without ``budget`` the budget is
    the smallest at which every source passes at least once, so no document is
    lost; with it, budgets are weight * budget.
    """
    names = sorted(totals)
    whole = sum(totals.values())
    if not whole:
        return [Share(n, 0, 0.0, 0) for n in names]
    shares = [totals[n] / whole for n in names]
    if target_entropy is not None:
        meets = lambda a: entropy(weights(shares, a)) <= target_entropy
    else:
        limit = MAX_REPEATS if max_repeats is None else max_repeats
        meets = lambda a: repeats(shares, weights(shares, a)) <= limit
    parts = weights(shares, bisect_exponent(meets))
    if budget is None:
        budget = max(totals[n] / w for n, w in zip(names, parts, strict=True) if w > 0)
    # Whole tokens, so that a source that just passes once is not cut by the last binary digit.
    return [
        Share(n, totals[n], w, round(w * budget)) for n, w in zip(names, parts, strict=True)
    ]


def _source_name(source: str = "source") -> Column:
    """A source as a key that tells null from any name."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with source key, block, place inside the block and tokens."""
    place = F.xxhash64(F.col("doc_id"), whole_text("text"))
    return (
        docs.withColumn("_mix_source", _source_name())
        .withColumn("_mix_place", place)
        .withColumn("_mix_block", F.pmod(F.xxhash64("_mix_place", F.lit("block")), F.lit(BLOCKS)).cast("int"))
        .withColumn("_mix_tokens", F.size(words(whole_text("text"))).cast("bigint"))
    )


def _block_order(epoch: Column) -> Column:
    """A block's place in the permutation of one pass."""
    return F.xxhash64("_mix_source", epoch.cast("int"), "_mix_block")


def block_plan(keyed: DataFrame, shares: list[Share]) -> DataFrame:
    """For each source and block: full passes, and up to which place one more pass takes it.

    ``_mix_upto`` is null when the last pass leaves the block out.
    """
    spark = keyed.sparkSession
    budgets = spark.createDataFrame(
        [(s.source, s.weight, s.full_passes, s.left) for s in shares],
        "_mix_source string, _mix_weight double, _mix_full int, _mix_left bigint",
    )
    block = ["_mix_source", "_mix_block"]
    blocks = keyed.groupBy(*block).agg(F.sum("_mix_tokens").alias("_mix_tokens"))
    order = Window.partitionBy("_mix_source").orderBy(
        _block_order(F.col("_mix_full")), "_mix_block"
    )
    left = F.col("_mix_left")
    summed = (
        blocks.join(budgets, "_mix_source")
        .withColumn("_mix_sum", F.sum("_mix_tokens").over(order))
        .withColumn("_mix_whole", (left > 0) & (F.col("_mix_sum") <= left))
    )
    summed = saved(summed, "mixing-blocks")
    # The block at the edge: documents by place, copies of a place together.
    room = left - F.col("_mix_sum") + F.col("_mix_tokens")
    edge = summed.where(~F.col("_mix_whole") & (room > 0)).select(*block, room.alias("_mix_room"))
    by_place = Window.partitionBy(*block).orderBy("_mix_place")
    inside = (
        keyed.groupBy(*block, "_mix_place")
        .agg(F.sum("_mix_tokens").alias("_mix_tokens"))
        .join(F.broadcast(edge) if fits_broadcast(edge) else edge, block)
        .withColumn("_mix_sum", F.sum("_mix_tokens").over(by_place))
        .where(F.col("_mix_sum") <= F.col("_mix_room"))
        .groupBy(*block)
        .agg(F.max("_mix_place").alias("_mix_last"))
    )
    upto = F.when(F.col("_mix_whole"), F.lit((1 << 63) - 1)).otherwise(F.col("_mix_last"))
    return summed.join(inside, block, "left").select(
        *block, "_mix_weight", "_mix_full", upto.alias("_mix_upto")
    )


def mixed(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_share: float | None = None,
) -> DataFrame:
    """The documents as often as the mixture takes them, with all their columns.

    Added are ``mix_weight`` (of the source), ``mix_epoch`` (from 0),
    ``mix_block`` and ``mix_order``: rows sorted by epoch and order are a
    permutation by blocks.  ``budget_share`` is the budget as a share of all
    tokens.  A null source is a source of its own.  Null and empty texts have
    no tokens and pass with the block they are in; a source without any tokens
    passes once.  Repeated rows pass together.  Columns that are named like the
    added ones are replaced; an empty table gives no rows.
    """
    added = ("mix_weight", "mix_epoch", "mix_block", "mix_order")
    carried = [c for c in docs.columns if c not in added]
    keyed = _keyed(docs)
    narrow = keyed.select("_mix_source", "_mix_block", "_mix_place", "_mix_tokens")
    narrow = saved(narrow, "mixing-tokens")
    totals = {
        r["_mix_source"]: r["n"]
        for r in narrow.groupBy("_mix_source").agg(F.sum("_mix_tokens").alias("n")).collect()
    }
    budget = None if budget_share is None else budget_share * sum(totals.values())
    shares = plan(totals, target_entropy, max_repeats, budget)
    blocks = saved(block_plan(narrow, shares), "mixing-plan")
    if fits_broadcast(blocks):
        blocks = F.broadcast(blocks)
    more = (F.col("_mix_place") <= F.col("_mix_upto")).cast("int")
    passes = F.col("_mix_full") + F.coalesce(more, F.lit(0))
    return (
        keyed.join(blocks, ["_mix_source", "_mix_block"])
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.greatest(passes, F.lit(1)) - 1)))
        .where(F.col("mix_epoch") < passes)
        .select(
            *carried,
            F.col("_mix_weight").alias("mix_weight"),
            "mix_epoch",
            F.col("_mix_block").alias("mix_block"),
            _block_order(F.col("mix_epoch")).alias("mix_order"),
        )
    )
