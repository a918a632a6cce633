"""Line dedup by winnowing over line hashes.

A text is a sequence of lines; lines without words are skipped over.  From each
line the shortest run of lines with at least ``MIN_WORDS`` words is a window,
and the line with the smallest hash in it (the first of equal ones) is selected
as fingerprint.  Windows that select the same line give one fingerprint.  Any
run of so many words that two places share contains a window of both, and both
select the same line in it, so no such run is missed.

Fingerprints are joined by the hash of their line; those of one place only end
there.  The others are verified by the lines of their windows: the first place
that has a window's lines keeps them, every later place is a match.  A match is
extended line by line both ways as far as the first place agrees, and the runs
found in later places are deleted.  So a line that many texts have (a footer)
costs each of its places the windows around it, and no pairs.

First is the document with the smallest doc_id (a whole number; null ids last,
then the hash of the text); inside a document, the first place.  Rows that agree
in doc_id and text are one document.  Only hashes and positions are shuffled
before the last join, and what a fingerprint carries has fewer than four times
``MIN_WORDS`` words and a line, whatever the length of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.links import look_up
from snapmart.llm.tables import saved
from snapmart.llm.texts import whole_text

MIN_WORDS = 50

# ``hashes``: of the lines around a fingerprint.  Of a window, ``first``, ``behind``,
# ``low`` and ``high`` are places in ``hashes``: its lines, and what is kept around them.
_PRINTS = (
    "doc_id bigint, text_hash bigint, print bigint, hashes array<bigint>, "
    "windows array<struct<mark:bigint,start:int,end:int,first:int,behind:int,low:int,high:int,"
    "again:boolean>>"
)
_ARROW_WINDOW = pa.struct(
    [("mark", pa.int64())]
    + [(n, pa.int32()) for n in ("start", "end", "first", "behind", "low", "high")]
    + [("again", pa.bool_())]
)
_ARROW_PRINTS = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "text_hash", "print")]
    + [("hashes", pa.list_(pa.int64())), ("windows", pa.list_(_ARROW_WINDOW))]
)
# Rows that are handed on at once.
_HELD = 5_000


def fingerprints(
    text: bytes | None, min_words: int = MIN_WORDS
) -> Iterator[tuple[int, list[int], list[dict]]]:
    """(hash of the selected line, hashes around it, windows that select it), in order.

    A window's ``mark`` is the hash of its lines, ``again`` says that the text had
    them before.  Around a window are kept lines of fewer words than a window
    each way; what agrees beyond that lies in windows of its own.
    """
    lines = [line.strip() for line in (text or b"").split(b"\n")]
    at = [i for i, line in enumerate(lines) if line]
    hashes = np.array([xxhash.xxh64_intdigest(lines[i]) for i in at], np.uint64)
    counts = np.array([len(lines[i].split()) for i in at], np.int64)
    # ends[k]: the first line index (of the lines with words) after the window from k.
    total = np.concatenate([[0], np.cumsum(counts)])
    ends = np.searchsorted(total, total[:-1] + min_words, side="left")
    # Lines from low[k] to k, and from k to high[k], have fewer words than a window.
    high = np.searchsorted(total, total + min_words, side="left") - 1
    low = np.searchsorted(total, total - min_words, side="right")
    listed = hashes.view(np.int64).tolist()
    seen: set[int] = set()
    selected, begin, found = -1, 0, []
    for k, end in enumerate(ends.tolist()):
        if end > len(at):
            break
        part = hashes[k:end]
        least = k + int(part.argmin())
        if least != selected:
            if found:
                yield listed[selected], listed[begin : begin + found[-1]["high"]], found
            selected, begin, found = least, int(low[k]), []
        mark = xxhash.xxh64_intdigest(part.tobytes()) - (1 << 63)
        found.append(
            {
                "mark": mark, "start": at[k], "end": at[end - 1] + 1, "first": k - begin,
                "behind": end - begin, "low": int(low[k]) - begin, "high": int(high[end]) - begin,
                "again": mark in seen,
            }
        )
        seen.add(mark)
    if found:
        yield listed[selected], listed[begin : begin + found[-1]["high"]], found


def prints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The fingerprints of every document; equal rows of a batch are read once."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_ARROW_PRINTS)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _ARROW_PRINTS, strict=True)],
            schema=_ARROW_PRINTS,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, read = [], set()
            ids, text_hashes = (c.to_pylist() for c in batch.columns[:2])
            texts = batch.column(2).cast(pa.binary())
            for doc_id, text_hash, text in zip(ids, text_hashes, texts, strict=True):
                if (doc_id, text_hash) in read:
                    continue
                read.add((doc_id, text_hash))
                for found in fingerprints(text.as_py(), min_words):
                    rows.append((doc_id, text_hash, *found))
                    if len(rows) == _HELD:
                        yield packed(rows)
                        rows = []
            yield packed(rows)

    body = whole_text("text")
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_hash"), "text"
    )
    return named.where(F.length("text") > 0).mapInArrow(run, _PRINTS)


def shared_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Windows of the fingerprints that have two places or more, with what lies around them.

    Rows of equal documents are one.  ``before`` is listed from the nearest line
    backwards.
    """
    found = saved(prints(docs, min_words), "line-prints")
    repeated = found.groupBy("print").count().where("count > 1").select("print")
    window = look_up(found, repeated, "print", "inner").distinct().select(
        "doc_id", "text_hash", "hashes", F.explode("windows").alias("w")
    )
    part = lambda begin, end: F.slice("hashes", begin + 1, end - begin)
    return window.select(
        "doc_id",
        "text_hash",
        *[f"w.{n}" for n in ("mark", "start", "end", "again")],
        F.reverse(part(F.col("w.low"), F.col("w.first"))).alias("before"),
        part(F.col("w.behind"), F.col("w.high")).alias("after"),
    )


def _same(left: Column, right: Column) -> Column:
    """How many leading elements of two arrays agree."""
    agree = F.zip_with(left, right, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.aggregate(
        agree,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, same: F.struct(
            (s["n"] + (s["on"] & same).cast("int")).alias("n"), (s["on"] & same).alias("on")
        ),
        lambda s: s["n"],
    )


def _document(prefix: str = "") -> Column:
    """A document's place in the order of first appearance."""
    return F.struct(
        F.col(f"{prefix}doc_id").isNull().alias("no_id"), f"{prefix}doc_id", f"{prefix}text_hash"
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``runs`` of each document (doc_id, text_hash) that repeat an earlier place.

    A run has the first line of its windows (``start``), the line after their
    last (``end``) and how many more lines with words agree on either side.
    """
    found = saved(shared_windows(docs, min_words), "line-windows")
    first = (
        found.groupBy("mark")
        .agg(
            F.min(F.struct(_document().alias("doc"), "start", "before", "after")).alias("first"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .drop("n")
    )
    later = look_up(found, first, "mark", "inner").where(
        F.col("again") | (_document() > F.col("first.doc"))
    )
    run = F.struct(
        "start",
        "end",
        _same(F.col("before"), F.col("first.before")).alias("more_before"),
        _same(F.col("after"), F.col("first.after")).alias("more_after"),
    )
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(run).alias("runs"))


def _without(text: str, runs) -> str:
    """The text without the lines of its runs."""
    lines = text.split("\n")
    worded = [i for i, line in enumerate(lines) if line.encode().strip()]
    order = {line: k for k, line in enumerate(worded)}
    dead = np.zeros(len(lines) + 1, np.int64)
    for r in runs:
        first = order[r["start"]] - r["more_before"]
        last = order[r["end"] - 1] + r["more_after"]
        dead[worded[first]] += 1
        dead[worded[last] + 1] -= 1
    kept = np.cumsum(dead[:-1]) == 0
    return "\n".join(line for line, keep in zip(lines, kept, strict=True) if keep)


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
    return pd.Series(
        [t if r is None else _without(t, r) for t, r in zip(texts, runs, strict=True)], dtype=object
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of the documents, with later repeated runs deleted from ``text``.

    Null and empty texts stay as they are; a text that repeats earlier runs
    throughout becomes empty or keeps what it has of its own.  Lines compare
    without surrounding blanks.  A column ``n_chars`` is counted anew where the
    text changed.  Rows that repeat a doc_id and text are one document and lose
    the same lines.  A text of any length is read whole.  Ids are whole numbers or
    null.  An empty table gives no rows.
    """
    key = lambda doc_id, text_hash: [
        F.coalesce(doc_id, F.lit(0).cast("bigint")).alias("_line_id"),
        doc_id.isNull().alias("_line_no_id"),
        text_hash.alias("_line_hash"),
    ]
    runs = repeated_runs(docs, min_words).select(
        *key(F.col("doc_id"), F.col("text_hash")), F.col("runs").alias("_line_runs")
    )
    keyed = docs.select(
        "*", *key(F.col("doc_id").cast("bigint"), F.xxhash64(whole_text("text")))
    )
    rows = look_up(keyed, runs, ["_line_id", "_line_no_id", "_line_hash"]).withColumn(
        "_line_new", _cut("text", "_line_runs")
    )
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("_line_new").alias("text"))
        elif c == "n_chars":
            changed = F.col("_line_runs").isNotNull()
            kind = docs.schema[c].dataType
            out.append(
                F.when(changed, F.length("_line_new").cast(kind)).otherwise(F.col(c)).alias(c)
            )
        else:
            out.append(F.col(c))
    return rows.select(*out)
