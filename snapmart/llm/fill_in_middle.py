"""Fill-in-middle transformation over a learned index of token boundaries.

A text is cut into tokens (runs of ASCII letters, any other character alone).
Its boundaries, 0 to the length of the text, are a sorted list of offsets, and
two cuts are looked up in it by rank.  The list is held as a piecewise-linear
function of the rank: a segment grows while one slope still passes within
``ERROR`` characters of all its offsets (a cone that each offset narrows), and
what the slope misses by is stored as one byte a boundary.  A cut is predicted
by the slope of its segment and corrected by the stored byte, which is exact.

The prefix ends at the first cut, the middle at the second.  ``psm`` puts prefix
and suffix before the middle, ``spm`` the suffix first, and ``plain`` leaves
the text as it is.  All draws follow from a digest of the key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.texts import whole_text

# FIXED VALUES: the marks in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
# Texts in a hundred that stay plain, and suffix-first ones in a hundred of the others.
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20
# Characters that a slope may miss a boundary by, and ranks of the longest segment.
ERROR = 120
MAX_SEGMENT = 1 << 16
# Bytes of texts whose boundaries are found at a time.
_BLOCK = 1 << 20
_GALLOP = 64


@dataclass
class RankIndex:
    """Offsets by rank, as error-bounded segments with one residual byte a rank."""

    starts: list[int] = field(default_factory=list)  # first rank of each segment
    bases: list[int] = field(default_factory=list)  # its offset
    slopes: list[float] = field(default_factory=list)
    residuals: list[np.ndarray] = field(default_factory=list)  # int8, one array a segment
    size: int = 0
    _open: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    _cone: tuple[float, float] = (-np.inf, np.inf)
    _fitted: int = 0  # ranks of the open segment that the cone has passed

    def add(self, offsets: np.ndarray) -> None:
        """Append rising offsets; fits as many whole segments as they end."""
        self.size += len(offsets)
        self._open = np.concatenate([self._open, offsets]) if len(self._open) else offsets
        while len(self._open) and self._grow():
            self._close()

    def finish(self) -> RankIndex:
        """Close the last segment."""
        if len(self._open):
            self._close()
        return self

    def _grow(self) -> bool:
        """Narrow the cone by the offsets at hand; whether one of them ends the segment."""
        offsets, step = self._open, _GALLOP
        at, (low, high) = max(1, self._fitted), self._cone
        ended = False
        while at < len(offsets) and at < MAX_SEGMENT and not ended:
            part = offsets[at : min(at + step, MAX_SEGMENT)] - offsets[0]
            runs = np.arange(at, at + len(part))
            lows = np.maximum(np.maximum.accumulate((part - ERROR) / runs), low)
            highs = np.minimum(np.minimum.accumulate((part + ERROR) / runs), high)
            apart = lows > highs
            fit = int(apart.argmax()) if apart[-1] else len(part)
            if fit:
                low, high = float(lows[fit - 1]), float(highs[fit - 1])
            at += fit
            ended = fit < len(part)
            step *= 2
        self._fitted, self._cone = at, (low, high)
        return ended or (at >= MAX_SEGMENT and at <= len(offsets))

    def _close(self) -> None:
        part, rest = self._open[: self._fitted], self._open[self._fitted :]
        if not self._fitted:
            part, rest = self._open[:1], self._open[1:]
        low, high = self._cone
        slope = (low + high) / 2 if len(part) > 1 else 0.0
        self.starts.append(self.size - len(self._open))
        self.bases.append(int(part[0]))
        self.slopes.append(slope)
        guess = part[0] + np.floor(slope * np.arange(len(part)) + 0.5).astype(np.int64)
        self.residuals.append((part - guess).astype(np.int8))
        self._open, self._cone, self._fitted = rest, (-np.inf, np.inf), 0

    def predicted(self, rank: int) -> tuple[int, int, int]:
        """(offset the slope gives, segment, place in it) of a rank."""
        at = int(np.searchsorted(self.starts, rank, side="right")) - 1
        place = rank - self.starts[at]
        return self.bases[at] + int(np.floor(self.slopes[at] * place + 0.5)), at, place

    def offset(self, rank: int) -> int:
        """The exact offset of a rank."""
        guess, at, place = self.predicted(rank)
        return guess + int(self.residuals[at][place])


def token_starts(data: np.ndarray, after_letter: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where tokens start in UTF-8, and the code points before each byte.

    ``after_letter`` says that the byte before the block is a letter.
    """
    lead = (data & 0xC0) != 0x80
    letter = ((data | 32) - np.uint8(97)) < 26
    starts = lead.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    if after_letter and len(data):
        starts[0] &= not letter[0]
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])
    return starts, chars


def _long_index(data: np.ndarray) -> RankIndex:
    """The index of one long text, whose boundaries are found block by block."""
    index, chars, letter = RankIndex(), 0, False
    for low in range(0, len(data), _BLOCK):
        block = data[low : low + _BLOCK]
        starts, before = token_starts(block, letter)
        index.add(chars + before[:-1][starts])
        chars += int(before[-1])
        letter = 97 <= int(block[-1]) | 32 < 123
    index.add(np.array([chars]))
    return index.finish()


def _cut(index: RankIndex, draws: tuple[int | None, int | None]) -> tuple:
    """(tokens, characters of prefix and of middle) under two draws; no cut for null draws."""
    tokens = index.size - 1
    if draws[0] is None or draws[1] is None:
        return tokens, None, None
    first, second = sorted(d % (tokens + 1) for d in draws)
    begin = index.offset(first)
    return tokens, begin, index.offset(second) - begin


def _cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> list[tuple]:
    """:func:`_cut` of each text of a batch; slices of about ``_BLOCK`` bytes at a time."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    draws = list(zip(one.to_pylist(), two.to_pylist(), strict=True))
    made: list[tuple] = []
    while len(made) < len(texts):
        i = len(made)
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + _BLOCK, side="right")) - 1)
        data = whole[ends[i] : ends[j]]
        if len(data) > _BLOCK:
            made.append(_cut(_long_index(data), draws[i]))
            continue
        rows = ends[i : j + 1] - ends[i]
        starts, chars = token_starts(data)
        firsts = rows[:-1][rows[:-1] < rows[1:]]
        starts[firsts] = True
        offsets = chars[:-1][starts]
        ranks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(starts, out=ranks[1:])
        for k, (a, b) in enumerate(zip(rows[:-1], rows[1:], strict=True)):
            tokens = int(ranks[b] - ranks[a])
            if draws[i + k][0] is None or draws[i + k][1] is None:
                made.append((tokens, None, None))
                continue
            index = RankIndex()
            index.add(np.append(offsets[ranks[a] : ranks[b]], chars[b]) - chars[a])
            made.append(_cut(index.finish(), draws[i + k]))
    return made


_CUT = pa.struct([("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])


def _cut_column() -> Column:
    @F.arrow_udf("struct<n: bigint, prefix_chars: bigint, middle_chars: bigint>")
    def cut(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        columns = list(zip(*_cuts(texts, one, two), strict=True)) or [[]] * 3
        parts = [pa.array(c, pa.int64()) for c in columns]
        return pa.StructArray.from_arrays(parts, fields=list(_CUT))

    return cut


def draw(digest: Column, number: int) -> Column:
    """The number-th group of eight hexadecimal digits of a digest, as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("bigint")


def transformed(
    docs: DataFrame,
    seed: int = SEED,
    plain_share: int = PLAIN_SHARE,
    suffix_first_share: int = SUFFIX_FIRST_SHARE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All rows and columns, with the transformed text and how it was made.

    Added are ``fim_tokens``, ``fim_form``, ``fim_output`` and the code points of
    prefix and middle, ``fim_prefix_chars`` and ``fim_middle_chars`` (null where
    plain).  A null text counts as empty, and an empty text or one that holds a
    mark is plain.  The draws follow from the key alone (a null key is drawn for
    like an empty one), so repeated rows come out alike.  Very long texts are
    read in blocks, with one byte held for each boundary.  Columns named like
    the added ones are replaced; an empty table gives no rows.
    """
    body = whole_text(text)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    marked = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    added = ("fim_tokens", "fim_form", "fim_output", "fim_prefix_chars", "fim_middle_chars")
    kept = [c for c in docs.columns if c not in added]
    drawn = docs.select(*kept, body.alias("_fim_body"), digest.alias("_fim_digest"), marked.alias("_fim_marked"))
    plain = (
        (F.col("_fim_body") == "")
        | F.col("_fim_marked")
        | (draw(F.col("_fim_digest"), 2) % 100 >= 100 - plain_share)
    )
    form = (
        F.when(plain, "plain")
        .when(draw(F.col("_fim_digest"), 3) % 100 < suffix_first_share, "spm")
        .otherwise("psm")
    )
    formed = drawn.withColumn("fim_form", form)
    draws = [
        F.when(F.col("fim_form") != "plain", draw(F.col("_fim_digest"), i)) for i in (0, 1)
    ]
    cut = formed.withColumn("_fim_cut", _cut_column()(F.col("_fim_body"), *draws))
    begin, size = F.col("_fim_cut.prefix_chars"), F.col("_fim_cut.middle_chars")
    parts = cut.withColumns(
        {
            "_fim_prefix": F.substr("_fim_body", F.lit(1), begin.cast("int")),
            "_fim_middle": F.substr("_fim_body", (begin + 1).cast("int"), size.cast("int")),
            "_fim_suffix": F.substr("_fim_body", (begin + size + 1).cast("int")),
        }
    )
    prefix, middle, suffix = (
        F.concat(F.lit(mark), F.col(name))
        for mark, name in ((PREFIX, "_fim_prefix"), (MIDDLE, "_fim_middle"), (SUFFIX, "_fim_suffix"))
    )
    output = (
        F.when(F.col("fim_form") == "psm", F.concat(prefix, suffix, middle))
        .when(F.col("fim_form") == "spm", F.concat(suffix, prefix, middle))
        .otherwise(F.col("_fim_body"))
    )
    return parts.select(
        *kept,
        F.col("_fim_cut.n").alias("fim_tokens"),
        "fim_form",
        output.alias("fim_output"),
        begin.alias("fim_prefix_chars"),
        size.alias("fim_middle_chars"),
    )


def _between(text: Column, mark: str, end: str) -> Column:
    """What stands between a mark and another mark, both of which occur once."""
    return F.substring_index(F.substring_index(text, end, 1), mark, -1)


def restored(rows: DataFrame, output: str = "fim_output", form: str = "fim_form") -> DataFrame:
    """Adds ``fim_restored``, the text that an output and its form alone give back.

    No part holds a mark and no mark overlaps itself, so each mark occurs once.
    A null output or form gives null.
    """
    made, middle = F.col(output), F.substring_index(F.col(output), MIDDLE, -1)
    text = (
        F.when(
            F.col(form) == "psm",
            F.concat(_between(made, PREFIX, SUFFIX), middle, _between(made, SUFFIX, MIDDLE)),
        )
        .when(
            F.col(form) == "spm",
            F.concat(_between(made, PREFIX, MIDDLE), middle, _between(made, SUFFIX, PREFIX)),
        )
        .when(F.col(form) == "plain", made)
    )
    return rows.withColumn("fim_restored", text)
