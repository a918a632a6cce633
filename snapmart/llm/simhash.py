"""SimHash near-duplicates by multi-index hashing.

A fingerprint's 64 bits are cut into segments.  For every segment there is a
table of all distinct fingerprints, keyed by the bits outside that segment.  If
two fingerprints differ in at most d bits, leaving out the segment with most
differing bits leaves few differences in the others, and the probes of a
fingerprint enumerate just those small Hamming balls, segment by segment.
Matches of the tables are then verified on all 64 bits.  With three segments
and two bits that is 22 probes a table: the key itself and the key with one bit
of one segment turned.

Equal fingerprints are one row before any of this, so copies cost nothing; a
fingerprint has a bounded number of others within d bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.links import components, look_up
from snapmart.llm.tables import saved

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 3
SEED = 42
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text: the bits set in over half of its shingles' hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, dtype=np.int64)
    for low in range(0, n, _CHUNK):
        part = zip(starts[low : low + _CHUNK], stops[low : low + _CHUNK], strict=False)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed number) of every row.

    ASCII letters count in lower case, words are parted by ASCII white space.
    A text with fewer words than a shingle is one shingle; null, empty and
    blank texts have the fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["key", "fp"]
            )

    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"key {kind}, fp bigint").withColumnRenamed("key", key)


def segment_masks(segments: int) -> list[int]:
    """Masks of the segments, from the high bits down."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    below = [(1 << BITS - cut) - 1 for cut in cuts]
    return [a ^ b for a, b in zip(below, below[1:], strict=False)]


def probe_masks(segments: int, max_bits: int) -> list[list[int]]:
    """For each segment left out, the differences to probe in the other segments."""
    masks = segment_masks(segments)
    bits = [[1 << i for i in range(BITS) if m >> i & 1] for m in masks]
    wanted: list[set[tuple[int, ...]]] = [set() for _ in masks]
    for counts in product(range(max_bits + 1), repeat=segments):
        if sum(counts) > max_bits:
            continue
        # Leave out the segment with most differences; of equal ones, one whose successor is equal.
        most = max(counts)
        equal = [s for s in range(segments) if counts[s] == most]
        out = next((s for s in equal if (s + 1) % segments in equal), equal[0])
        if most == 0:
            out = 0
        wanted[out].add(tuple(0 if s == out else c for s, c in enumerate(counts)))
    found = []
    for patterns in wanted:
        flips = set()
        for counts in patterns:
            balls = [combinations(bits[s], c) for s, c in enumerate(counts)]
            flips |= {sum(map(sum, picked)) for picked in product(*map(list, balls))}
        found.append(sorted(flips))
    return found


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(v)).cast("bigint") for v in values])


def linked(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (column ``fp``) at most so many bits apart."""
    segments = max(segments, 2)
    masks = segment_masks(segments)
    flips = probe_masks(segments, max_bits)
    entry = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("part"),
                    F.col("fp").bitwiseAND(F.lit(_signed(~m & (1 << BITS) - 1))).alias("rest"),
                )
                for s, m in enumerate(masks)
            ]
        )
    )
    table = prints.select("fp", entry.alias("k")).select("k.*", F.col("fp").alias("b"))

    def probes(s: int) -> Column:
        # Of two fingerprints that differ, the one with the higher differing bit unset asks.
        def ask(flip: Column) -> Column:
            turned = F.col("fp").bitwiseXOR(flip)
            return F.struct(
                F.lit(s).alias("part"),
                turned.bitwiseAND(F.lit(_signed(~masks[s] & (1 << BITS) - 1))).alias("rest"),
            )

        high = _longs([1 << f.bit_length() - 1 if f else 0 for f in flips[s]])
        pairs = F.arrays_zip(_longs(flips[s]).alias("flip"), high.alias("high"))
        asked = F.filter(pairs, lambda p: F.col("fp").bitwiseAND(p["high"]) == 0)
        return F.transform(asked, lambda p: ask(p["flip"]))

    asks = F.concat(*[probes(s) for s in range(segments) if flips[s]])
    asked = prints.select("fp", F.explode(asks).alias("k")).select("k.*", F.col("fp").alias("a"))
    met = asked.join(table, ["part", "rest"]).where(
        (F.col("a") != F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    return met.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``key``, ``fp`` and ``component_id``: the smallest key reachable over near texts.

    Every row comes back once, repeated rows too; a null key never becomes a
    component's id unless all its keys are null.  An empty table gives no rows;
    other columns are ignored.  Components are built on distinct fingerprints,
    so a group of copies of any size is one node.
    """
    own = saved(with_fingerprints(docs, key, text, shingle_words), "simhash")
    distinct = saved(own.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    roots = components(linked(distinct.select("fp"), max_bits))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = look_up(grouped, smallest, "root").select("fp", "component_id")
    return look_up(own, named, "fp").select(key, "fp", "component_id")


def hex_text(fp: str) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, spark_key: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the smallest id; all columns pass.

    Repeated rows with the same id count as copies: one of them stays.  Among
    documents without an id one stays only if no other document is near.
    """
    row = "_simhash_row"
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    near = near_duplicates(numbered, row, "text")
    ids = numbered.select(row, F.col(spark_key).alias("_simhash_key"))
    # Smallest id first, nulls last; equal ids by row.
    key = F.col("_simhash_key")
    place = F.struct(key.isNull().alias("none"), key, F.col(row).alias("at"))
    stays = (
        near.join(ids, row)
        .groupBy("component_id")
        .agg(F.min(place)["at"].alias(row))
        .select(row)
    )
    return numbered.join(stays, row, "left_semi").drop(row)
