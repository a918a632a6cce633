"""I-Match document fingerprints.

Terms are runs of anything but blanks, in lower case.  A term belongs to the
lexicon when its inverse document frequency ln(N / df) lies in a chosen band,
so the lexicon has at most exp(max_idf) terms for every distinct term of an
average document, however large the corpus.  N and df count distinct texts, so
that copies do not make their terms common.  A document keeps its distinct
terms of the lexicon, sorted, and hashes them once for each of several random
subsets of the lexicon.  Two documents are alike in a subset when the hashes
agree; subsets that keep no term of either say nothing.

Two sizes of subsets are drawn: each keeps one in 64 terms of the lexicon, for
ordinary documents, or one in 512, for long ones of which an edit would touch
every larger subset.  Terms that no subset draws are left aside from the start.
The likeness is the share of equal hashes in the smaller subsets if enough of
them hold a term, else in the larger ones.  A text with more terms that are too
common for the lexicon than terms in it (a near copy in a large group) is thin:
it is hashed over all its drawn terms, and so is whatever it is compared with.

Everything is DataFrame expressions; the lexicon is the only thing that is sent
to all tasks, as one array that tests a term in one step.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.neighbours import with_next
from snapmart.llm.tables import saved
from snapmart.llm.texts import constant_longs, whole_text

MIN_IDF = 1.5
MAX_IDF = 7.0
# (one in how many terms a subset keeps, how many subsets)
TIERS = ((64, 16), (512, 16))
# Non-empty subsets that the finer tier needs to decide the likeness.
ENOUGH = 8
HASH_DIGITS = 6
EMPTY = "-" * HASH_DIGITS
# Low bits of a term's hash that order it inside a subset; the subset is above them.
_TERM_BITS = 58
# High bits of the hash choose the larger subsets, bits further down the smaller ones.
_SHIFTS = (0, 20)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    line = F.lower(text)
    for blank in "\t\n\x0b\x0c\r":
        line = F.replace(line, F.lit(blank), F.lit(" "))
    pieces = F.filter(F.split(line, " "), lambda t: t != "")
    return F.array_distinct(F.transform(pieces, lambda t: F.xxhash64(t)))


def _subset(h: Column, tier: int) -> Column:
    """The subset of a tier that draws a term; none if not below the tier's count."""
    return F.pmod(F.shiftright(h, _SHIFTS[tier]), F.lit(TIERS[tier][0]))


def drawn(h: Column) -> Column:
    """Whether any subset draws a term."""
    return (_subset(h, 0) < TIERS[0][1]) | (_subset(h, 1) < TIERS[1][1])


def lexicon(
    docs: DataFrame, text: str = "text", min_idf: float = MIN_IDF, max_idf: float = MAX_IDF
) -> DataFrame:
    """Drawn terms (``term``, ``df``, ``common``) in the idf band, or below it (common).

    Each distinct text counts once.
    """
    body = whole_text(text)
    once = docs.groupBy(F.md5(body).alias("_text")).agg(
        F.first(F.filter(terms(body), drawn)).alias("_drawn")
    )
    counted = once.select(F.explode("_drawn").alias("term")).groupBy("term")
    total = docs.agg(F.count_distinct(F.md5(body)).alias("n")).first()["n"]
    idf = F.log(F.lit(float(max(total, 1))) / F.col("df"))
    return (
        counted.agg(F.count(F.lit(1)).alias("df"))
        .where(idf <= max_idf)
        .select("term", "df", (idf < min_idf).alias("common"))
    )


def _member_test(lexicon_terms: DataFrame) -> Callable[[Column], Column]:
    """A test for terms of the lexicon, which travels as a few constant arrays.

    A term sits in the first array at its slot; terms that find the slot taken
    sit in the next array at another slot, and so on until all are placed.
    """
    left = sorted(r["term"] for r in lexicon_terms.select("term").collect())
    levels: list[tuple[Column, int, int]] = []
    while left:
        size = 4 * len(left) + 1
        seats, moved = [0] * size, []
        for term in left:
            at = (term >> len(levels)) % size
            if seats[at]:
                moved.append(term)
            else:
                seats[at] = term
        levels.append((constant_longs(seats), len(levels), size))
        left = moved

    def test(h: Column) -> Column:
        found = F.lit(False)
        for seats, shift, size in levels:
            moved = F.shiftright(h, shift) if shift else h
            found = found | (F.get(seats, F.pmod(moved, F.lit(size)).cast("int")) == h)
        return found

    return test


def _tagged(kept: str, tier: int) -> Column:
    """The kept terms of a tier in order of subset, then term, with a mark before each subset."""
    count = TIERS[tier][1]
    tags = F.transform(
        F.filter(kept, lambda h: _subset(h, tier) < count),
        lambda h: F.shiftleft(_subset(h, tier), _TERM_BITS).bitwiseOR(
            h.bitwiseAND(F.lit((1 << _TERM_BITS) - 1))
        ),
    )
    marks = constant_longs(k << _TERM_BITS for k in range(count + 1))
    return F.sort_array(F.concat(tags, marks))


def _digits(members: Column) -> Column:
    return F.lower(F.right(F.lpad(F.hex(F.xxhash64(members)), 16, "0"), F.lit(HASH_DIGITS)))


def _subset_hashes(tagged: str, count: int) -> Column:
    """For each subset the hash of the kept terms it holds, or ``EMPTY``."""

    def one(k: Column) -> Column:
        begin = F.array_position(tagged, F.shiftleft(k.cast("bigint"), _TERM_BITS))
        end = F.array_position(tagged, F.shiftleft((k + 1).cast("bigint"), _TERM_BITS))
        members = F.slice(tagged, (begin + 1).cast("int"), (end - begin - 1).cast("int"))
        return F.when(end == begin + 1, EMPTY).otherwise(_digits(members))

    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), one)


def with_fingerprint(docs: DataFrame, lexicon_terms: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the subset hashes of a text, larger subsets first, on two bases.

    ``out.band`` (array<string>) is over terms of the lexicon, ``out.whole`` over
    all drawn terms; ``out.thin`` says that the lexicon holds too few terms of the
    text, none or fewer than are too common for it.  A text without drawn terms (a
    few words) is hashed over all its terms as its only subset.  One without terms
    (null, empty, only blanks) has empty subsets.
    """
    carried = docs.columns
    parts = docs.withColumn("_terms", terms(whole_text(text))).withColumn(
        "_drawn", F.filter("_terms", drawn)
    )
    in_band = _member_test(lexicon_terms.where("NOT common"))
    too_common = _member_test(lexicon_terms.where("common"))
    kept = parts.withColumn("_kept", F.filter("_drawn", in_band)).withColumn(
        "_thin",
        (F.size("_kept") == 0) | (F.size("_kept") < F.size(F.filter("_drawn", too_common))),
    )
    tags = {
        f"_tags{name}{i}": _tagged(name, i)
        for name in ("_kept", "_drawn")
        for i in range(len(TIERS))
    }
    others = F.array_repeat(F.lit(EMPTY), sum(count for _, count in TIERS) - 1)
    alone = F.concat(F.array(_digits(F.sort_array("_terms"))), others)

    def hashes(name: str) -> Column:
        tiers = [_subset_hashes(f"_tags{name}{i}", count) for i, (_, count) in enumerate(TIERS)]
        few = (F.size("_drawn") == 0) & (F.size("_terms") > 0)
        return F.when(few, alone).otherwise(F.concat(*tiers))

    return kept.withColumns(tags).select(
        *carried,
        F.struct(
            hashes("_kept").alias("band"), hashes("_drawn").alias("whole"), F.col("_thin").alias("thin")
        ).alias(out),
    )


def fingerprint(column: str) -> Column:
    """The subset hashes that stand for a text: over the lexicon unless that holds too little."""
    return F.when(F.col(f"{column}.thin"), F.col(f"{column}.whole")).otherwise(
        F.col(f"{column}.band")
    )


def common_likeness(left: str, right: str) -> Column:
    """:func:`likeness` on one basis: all drawn terms of both if either text is thin."""
    return F.when(
        F.col(f"{left}.thin") | F.col(f"{right}.thin"), likeness(f"{left}.whole", f"{right}.whole")
    ).otherwise(likeness(f"{left}.band", f"{right}.band"))


def likeness(left: str, right: str) -> Column:
    """Share of equal subset hashes of two fingerprints, 0 to 1.

    Two fingerprints without any term are alike (1); one without against one
    with terms is not (0).
    """
    start, shares, counts = 1, [], []
    for _, count in TIERS:
        pairs = F.zip_with(
            F.slice(left, start, count),
            F.slice(right, start, count),
            lambda a, b: F.when((a == EMPTY) & (b == EMPTY), F.lit(None)).otherwise(
                (a == b).cast("int")
            ),
        )
        said = F.filter(pairs, lambda x: x.isNotNull())
        counts.append(F.size(said))
        shares.append(
            F.aggregate(said, F.lit(0), lambda s, x: s + x).cast("double") / F.size(said)
        )
        start += count
    coarse, fine = shares
    return (
        F.when((counts[0] == 0) & (counts[1] == 0), F.lit(1.0))
        .when((counts[1] >= ENOUGH) | (counts[0] == 0), fine)
        .otherwise(coarse)
    )


def fingerprint_text(column: Column) -> Column:
    """A fingerprint as one string."""
    return F.array_join(column, "")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text ends with the beginning of the next document by descending
    doc_id.  Null texts count as empty, null doc_ids come last, repeated rows
    are kept each; an empty table gives no rows.  Other columns are ignored.
    """
    rows = docs.select("doc_id", whole_text("text").alias("text"))
    terms_kept = saved(lexicon(rows), "lexicon")
    own = with_fingerprint(rows, terms_kept, "text", "own")
    near = with_next(own, "doc_id", "text", ["text", "own"])
    chars = F.length("text")
    cut = F.floor(chars / 3).cast("int")
    edited = near.select(
        "doc_id",
        chars.cast("bigint").alias("n_chars"),
        "own",
        "next_own",
        F.concat(
            F.substring("text", F.lit(1), chars - cut), F.substring("next_text", F.lit(1), cut)
        ).alias("edited"),
    )
    both = with_fingerprint(edited, terms_kept, "edited", "changed")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(fingerprint("own")).alias("fingerprint"),
        fingerprint_text(fingerprint("changed")).alias("edited_fingerprint"),
        common_likeness("own", "changed").alias("near_edited"),
        common_likeness("own", "next_own").alias("near_next"),
    )
