"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

The patterns give the base spans.  The entropy scan adds spans of kind
``entropy``.  Runs of 20 or more characters that secrets are made of are cut
at what the allow-list matches; inside each piece a window of 20 characters
slides along, and the Shannon entropy of the window is kept up to date from
the count of the character that enters and of the one that leaves.  A window
counts when its entropy reaches the threshold of its character class;
overlapping windows merge into one span.  So an allowed word silences the
windows that touch it, and nothing else in its run.  A span inside a base span
is left out.

Entropies are sums of whole numbers (micro-bits), so that they are exact.
Everything is Column expressions on the text of one row.  Folds hand on what
they find in blocks, so that the work grows with the length of a text and not
with its square, however many hits it has.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.texts import whole_text

# FIXED VALUES: the patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_MIN = 12
# Runs are whole, so a least length in the pattern keeps the same matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# The characters of a candidate; classes are ranges of places in it, counted from 1.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
# Least bits per character of a window, by the class of its characters.  Windows
# without digits count if they are letters throughout.
HEX_BITS = 3.0
LETTERS_AND_DIGITS_BITS = 3.5
MIXED_BITS = 3.7
ONE_CASE_BITS = 3.6
BOTH_CASES_BITS = 3.9
# What looks random but is no secret.  The list is applied in its order: what is
# left beside the matches of a pattern is what the next one is matched in.
_WORDS = r"(?:[A-Z]?[a-z]{1,15}|[0-9]{1,8})"
ALLOW_LIST = (
    r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])",
    r"(?i)example|sample|dummy|placeholder|changeme|redacted",
    r"(?i)0123456789|abcdefghij|qwertyuiop",
    r"^//[a-z0-9-]{1,63}(?=/|$)",
    rf"(?:/{_WORDS}(?:[-_]{_WORDS}){{0,4}}(?=/|$)){{2,40}}",
    r"[-_=+/]{4,}",
)
_MICRO = 1_000_000
# Results of a fold are handed on after so many steps.
_HITS = 128
_EVENTS = 4096


def _c_log_c(count: int) -> int:
    """count * log2(count) in micro-bits."""
    return round(count * math.log2(count) * _MICRO) if count else 0


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


_SPAN = "struct<start:int,kind:int,end:int>"
_SPANS = f"array<{_SPAN}>"
_PIECE = "struct<start:int,part:string>"


def _blocks(items: Column, size: int) -> Column:
    """An array cut into arrays of ``size`` elements."""
    starts = F.sequence(F.lit(1), F.size(items), F.lit(size))
    cut = F.transform(starts, lambda at: F.slice(items, at, size))
    return F.when(F.size(items) > 0, cut).otherwise(F.array())


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _emitted(
    items: Column,
    zero: dict[str, Column],
    move: Callable[[Column, Column], dict[str, Column]],
    emit: Callable[[Column, Column], Column],
    kind: str,
    size: int,
    rest: Callable[[Column], Column] | None = None,
) -> Column:
    """What a fold emits, in order.

    ``move`` gives the next state of an item, ``emit`` (of the state before and
    the item) an element or null, ``rest`` an array to put behind the last one.
    Elements are gathered for a block of items at a time: appending to one
    array throughout would copy it at every step.
    """
    none = F.array().cast(f"array<{kind}>")

    def state(fields: dict[str, Column], out: Column, done: Column) -> Column:
        return F.struct(
            *[c.alias(n) for n, c in fields.items()], out.alias("out"), done.alias("done")
        )

    def step(s: Column, item: Column) -> Column:
        new = emit(s, item)
        grown = F.when(new.isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(new)))
        return state(move(s, item), grown, s["done"])

    def block(s: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            s,
            step,
            lambda e: state(
                {n: e[n] for n in zero}, none, F.concat(e["done"], F.array(e["out"]))
            ),
        )

    def finish(s: Column) -> Column:
        flat = F.flatten(s["done"])
        return flat if rest is None else F.concat(flat, rest(s))

    start = state(zero, none, F.array().cast(f"array<array<{kind}>>"))
    return _with(items, lambda x: F.aggregate(_blocks(x, size), start, block, finish))


def located(
    text: Column, pattern: str, kind: int, group: int = 0, least: int = 0
) -> Column:
    """Spans (code points, end exclusive) of the matches whose group has a least length."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), sizes.alias("size"))
    found = _emitted(
        parts,
        {"at": F.lit(0)},
        lambda s, p: {"at": s["at"] + p["gap"] + F.coalesce(p["hit"], F.lit(0))},
        lambda s, p: F.when(
            p["size"] >= least,
            _span(s["at"] + p["gap"], kind, s["at"] + p["gap"] + p["hit"]),
        ),
        _SPAN,
        _HITS,
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def candidates(text: Column) -> Column:
    """The runs that may hold a secret: where each begins, and the run."""
    gaps = F.transform(F.split(text, CANDIDATE, -1), F.length)
    runs = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    found = _emitted(
        F.arrays_zip(gaps.alias("gap"), runs.alias("run")),
        {"at": F.lit(0)},
        lambda s, p: {"at": s["at"] + p["gap"] + F.coalesce(F.length(p["run"]), F.lit(0))},
        lambda s, p: F.when(
            p["run"].isNotNull(),
            F.struct((s["at"] + p["gap"]).alias("start"), p["run"].alias("part")),
        ),
        _PIECE,
        _HITS,
    )
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(f"array<{_PIECE}>"))


def beside(pieces: Column, pattern: str) -> Column:
    """What is left of pieces beside the matches of a pattern, if a window fits into it."""

    def cut(piece: Column) -> Column:
        hits = F.regexp_extract_all(piece["part"], F.lit(pattern), F.lit(0))
        parts = F.arrays_zip(
            F.split(piece["part"], pattern, -1).alias("part"),
            F.transform(hits, F.length).alias("hit"),
        )
        left = _emitted(
            parts,
            {"at": piece["start"]},
            lambda s, p: {
                "at": s["at"] + F.length(p["part"]) + F.coalesce(p["hit"], F.lit(0))
            },
            lambda s, p: F.when(
                F.length(p["part"]) >= WINDOW, F.struct(s["at"].alias("start"), p["part"])
            ),
            _PIECE,
            _HITS,
        )
        return F.when(piece["part"].rlike(pattern), left).otherwise(F.array(piece))

    return F.flatten(F.transform(pieces, cut))


def _events(run: Column) -> Column:
    """What happens to the window, one number each.

    A character that enters is its place in the alphabet, one that leaves is
    that place below zero, and 0 is a full window to be tested.
    """
    places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def of(codes: Column) -> Column:
        def one(code: Column, i: Column) -> Column:
            return (
                F.when(i < WINDOW - 1, F.array(code))
                .when(i == WINDOW - 1, F.array(code, F.lit(0)))
                .otherwise(F.array(-F.get(codes, i - WINDOW), code, F.lit(0)))
            )

        return F.flatten(F.transform(codes, one))

    return _with(places, of)


# How often each character of the alphabet is in the window: one letter for each, A for 0.
_NO_COUNTS = "A" * len(ALPHABET)


def high_windows(run: Column) -> Column:
    """Merged spans inside a run of candidate characters whose windows reach their threshold."""
    gains = F.array(*[F.lit(_c_log_c(c + 1) - _c_log_c(c)) for c in range(WINDOW)])
    # Places of the classes in the alphabet, first and last.
    classes = {"digits": (1, 10), "not_hex": (17, 36), "lower": (11, 36), "upper": (37, 62)}

    def moved(s: Column, event: Column) -> dict[str, Column]:
        place = F.abs(event)
        by = F.signum(event).cast("int")
        count = F.ascii(F.substring(s["counts"], place, F.lit(1))) - ord("A")
        new = F.char(count + by + ord("A"))
        # The count before an enter, or after a leave: between the same two counts.
        step = F.get(gains, count - (by < 0).cast("int"))
        of = lambda first, last: place.between(first, last).cast("int") * by
        return {
            "at": s["at"] + (by > 0).cast("int"),
            "sum": s["sum"] + step * by,
            "counts": F.overlay(s["counts"], new, place, F.lit(1)),
            "digits": s["digits"] + of(*classes["digits"]),
            "lower": s["lower"] + of(*classes["lower"]),
            "upper": s["upper"] + of(*classes["upper"]),
            "not_hex": s["not_hex"] + of(*classes["not_hex"]) + (place > 42).cast("int") * by,
            "first": s["first"],
            "last": s["last"],
        }

    def high(s: Column) -> Column:
        # H = log2(W) - sum(c log2 c) / W
        bits = lambda least: s["sum"] <= F.lit(
            round((math.log2(WINDOW) - least) * WINDOW * _MICRO)
        )
        both = (s["upper"] > 0) & (s["lower"] > 0)
        some = (s["upper"] > 0) | (s["lower"] > 0)
        letters = s["upper"] + s["lower"] == WINDOW
        return (
            F.when(s["digits"] == 0, letters & F.when(both, bits(BOTH_CASES_BITS)).otherwise(
                bits(ONE_CASE_BITS)
            ))
            .when(s["not_hex"] == 0, bits(HEX_BITS))
            .when(both, bits(MIXED_BITS))
            .when(some, bits(LETTERS_AND_DIGITS_BITS))
            .otherwise(F.lit(False))
        )

    def tested(s: Column) -> dict[str, Column]:
        apart = s["last"] < s["at"] - WINDOW
        same = {n: s[n] for n in zero}
        return same | {
            "first": F.when(high(s) & apart, s["at"] - WINDOW).otherwise(s["first"]),
            "last": F.when(high(s), s["at"]).otherwise(s["last"]),
        }

    def move(s: Column, event: Column) -> dict[str, Column]:
        slid, test = moved(s, event), tested(s)
        both = F.when(event == 0, F.struct(*[test[n].alias(n) for n in zero])).otherwise(
            F.struct(*[slid[n].alias(n) for n in zero])
        )
        return {"s": both}

    zero: dict[str, Column] = {
        "at": F.lit(0),
        "sum": F.lit(0),
        "counts": F.lit(_NO_COUNTS),
        **{n: F.lit(0) for n in ("digits", "lower", "upper", "not_hex")},
        # The span that is still open; none if it ends before the run begins.
        "first": F.lit(-1),
        "last": F.lit(-1),
    }
    span = lambda s: F.struct(s["first"].alias("start"), s["last"].alias("end"))
    pair = "struct<start:int,end:int>"
    # A span is complete once a window starts behind its end.
    done = lambda s: (s["last"] >= 0) & (s["last"] == s["at"] - WINDOW - 1)
    found = _emitted(
        _events(run),
        {"s": F.struct(*[c.alias(n) for n, c in zero.items()])},
        lambda state, event: move(state["s"], event),
        lambda state, event: F.when((event == 0) & done(state["s"]), span(state["s"])),
        pair,
        _EVENTS,
        lambda state: F.when(
            (state["s"]["last"] >= 0) & (state["s"]["last"] >= state["s"]["at"] - WINDOW),
            F.array(span(state["s"])),
        ).otherwise(F.array().cast(f"array<{pair}>")),
    )
    possible = run.rlike(f"[0-9]|[A-Za-z]{{{WINDOW}}}")
    return F.when(possible, found).otherwise(F.array().cast(f"array<{pair}>"))


def entropy_spans(runs: str | Column, allow_list: Sequence[str] = ALLOW_LIST) -> Column:
    """Entropy spans of a text, given its candidates."""
    pieces = F.col(runs) if isinstance(runs, str) else runs
    for pattern in allow_list:
        pieces = beside(pieces, pattern)

    def inside(piece: Column) -> Column:
        return F.transform(
            high_windows(piece["part"]),
            lambda s: _span(piece["start"] + s["start"], 3, piece["start"] + s["end"]),
        )

    return F.flatten(F.transform(pieces, inside))


def outside(spans: Column) -> Column:
    """Spans sorted by start, then kind, without entropy spans inside a base span."""
    return _emitted(
        F.sort_array(spans),
        {"reach": F.lit(-1)},
        lambda s, x: {"reach": F.when(x["kind"] < 3, F.greatest(s["reach"], x["end"])).otherwise(
            s["reach"]
        )},
        lambda s, x: F.when((x["kind"] < 3) | (x["end"] > s["reach"]), x),
        _SPAN,
        _HITS,
    )


def written(spans: str | Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(
    docs: DataFrame, text: str = "text", allow_list: Sequence[str] = ALLOW_LIST
) -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, kind, end), sorted by start, then kind.

    Null and empty texts have none.  All other columns pass unchanged; columns
    that are named ``base`` or ``spans`` are replaced.  A text is read whole,
    however long; the work grows with its length.  Each row is scanned by
    itself, so repeated rows give the same spans each and an empty table gives
    no rows.  Patterns of the allow-list must not match an empty text.
    """
    carried = [c for c in docs.columns if c not in ("base", "spans")]
    body = whole_text(text)
    base = F.sort_array(
        F.concat(
            located(body, ASSIGN, 0, 2, ASSIGN_MIN), located(body, ACCESS, 1), located(body, HEX, 2)
        )
    )
    found = docs.select(
        *carried, base.alias("base"), candidates(body).alias("_secret_runs")
    )
    every = outside(F.concat("base", entropy_spans("_secret_runs", allow_list)))
    return found.select(
        *carried,
        "base",
        F.when(F.size("_secret_runs") > 0, every).otherwise(F.col("base")).alias("spans"),
    )


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of each kind per document, the digest of the base spans, and all spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    count = lambda kind: F.size(
        F.filter("spans", lambda s: s["kind"] == kind)
    ).cast("bigint")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(written("base"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )
