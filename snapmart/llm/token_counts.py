"""Token counts of whole texts by a merging tokenizer, without their ids.

What the library does to a text up to its merges (normalisation, cutting into
pre-tokens) depends on the neighbourhood alone; the merges of a pre-token
depend on nothing but the pre-token.  So pre-tokens are counted over the corpus,
the pieces of each distinct one are counted once, and these counts are joined
to the frequencies of the pre-tokens in every document and summed.

The join has two parts that together are whole: the most frequent pre-tokens, at
most ``COMMON`` of at most ``KEY_BYTES`` bytes, are sent to every task, and what
a document has of rarer ones is shuffled by pre-token.  A pre-token with many
rows is a frequent one, so no key of the shuffled part is hot.

Texts of code points below ``PLAIN_LIMIT`` are cut by class tables, a slice of
texts at once; the tables are asked of the library itself.  Other texts are cut by
the library.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmart.llm.tables import saved
from snapmart.llm.texts import whole_text

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
# Pre-tokens whose counts are sent to every task, and the bytes of the longest key.
COMMON = 1 << 18
KEY_BYTES = 64
# Code points that class tables cover: all of these are their own NFC.
PLAIN_LIMIT = 0x180
# Characters that are cut at a time, and pre-tokens that a task counts before it passes them on.
_SLICE = 1 << 20
_HELD = 200_000
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
# FIXED VALUES: the endings that the tokenizer's pattern takes off as one pre-token.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Cutter:
    """Cuts texts into pre-tokens, as the library does."""

    def __init__(self, described: str) -> None:
        spec = json.loads(described)
        steps = spec["pre_tokenizer"]["pretokenizers"]
        last = steps[-1]
        if spec["pre_tokenizer"]["type"] != "Sequence" or last["type"] != "ByteLevel":
            raise ValueError("the pre-tokens of this tokenizer are not spelled as bytes last")
        if last["use_regex"] or last["add_prefix_space"]:
            raise ValueError("the bytes step of this tokenizer cuts or adds")
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens of this tokenizer are looked for in normalised texts")
        self._marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        spec["pre_tokenizer"]["pretokenizers"] = steps[:-1]
        spec["model"] = _NO_MODEL
        self._library = Tokenizer.from_str(json.dumps(spec))
        self._classes = self._plain_classes()

    def _library_cut(self, text: str) -> list[str]:
        plain = self._library.normalizer.normalize_str(text)
        return [w for w, _ in self._library.pre_tokenizer.pre_tokenize_str(plain)]

    def _plain_classes(self) -> np.ndarray:
        """Class of each code point below the limit: alone, after a letter, and doubled."""
        classes = np.full(PLAIN_LIMIT, _SPACE, np.uint8)
        for code in range(PLAIN_LIMIT):
            char = chr(code).lower()
            if not self._library_cut(char):
                continue
            if len(self._library_cut("a" + char)) == 1:
                classes[code] = _LETTER
            else:
                classes[code] = _OTHER if len(self._library_cut(char * 2)) == 1 else _NUMBER
        return classes

    def marked(self, text: str) -> tuple[str, int]:
        """The text with its special strings as blanks, and how many they were."""
        found = 0
        for mark in self.special:
            if mark in text:
                text, found = self._marks.subn(" ", text)
                break
        return text, found

    def is_plain(self, text: str) -> bool:
        """Whether the class tables cut a text as the library does."""
        return text.isascii() or not _BEYOND.search(text)

    def cut_plain(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """(pre-tokens in order, index of the text of each) of texts that are all plain."""
        # A line break between two texts ends every pre-token and every run.
        lowered = [t.lower() for t in texts]
        codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
        of_text = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
        classes = self._classes[codes]
        before = np.concatenate([[_SPACE], classes[:-1]]).astype(np.uint8)
        starts = (classes != _SPACE) & ((classes != before) | (classes == _NUMBER))
        self._take_endings(codes, classes, starts)
        inside = classes != _SPACE
        wide = 1 + (codes >= 0x80)
        ends = np.cumsum(np.where(inside, wide, 0))
        places = np.flatnonzero(starts)
        offsets = np.append(ends[places] - wide[places], ends[-1]).astype(np.int32)
        kept = codes[inside].astype("<u4").tobytes().decode("utf-32-le").encode()
        words = pa.StringArray.from_buffers(
            len(places), pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept)
        )
        return words, of_text[places]

    def _take_endings(self, codes: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> None:
        """Let an apostrophe that starts a pre-token take the letters of an ending."""
        quotes = np.flatnonzero((codes == ord("'")) & starts)
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        free = np.ones(len(quotes), bool)
        for ending in ENDINGS:
            letters = [ord(c) for c in ending[1:]]
            hit = free.copy()
            for k, letter in enumerate(letters, 1):
                hit &= padded[quotes + k] == letter
            at = quotes[hit]
            free &= ~hit
            starts[at + 1] = False
            after = at + len(ending)
            # The letters behind an ending are a pre-token of their own.
            starts[after] |= classes[np.minimum(after, len(classes) - 1)] == _LETTER

    def frequencies(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(distinct pre-tokens, text, pre-token and count of each pair that occurs)."""
        plain = [i for i, t in enumerate(texts) if self.is_plain(t)]
        rest = sorted(set(range(len(texts))) - set(plain))
        words, of_text = self.cut_plain([texts[i] for i in plain]) if plain else (pa.array([], pa.string()), np.zeros(0, int))
        of_text = np.asarray(plain, np.int64)[of_text] if plain else of_text
        cut = [self._library_cut(texts[i]) for i in rest]
        if rest:
            words = pa.concat_arrays([words, pa.array([w for c in cut for w in c], pa.string())])
            of_text = np.concatenate([of_text, np.repeat(rest, [len(c) for c in cut])])
        coded = pc.dictionary_encode(words)
        distinct = _strings(coded.dictionary)
        pairs = of_text.astype(np.int64) * max(1, len(distinct)) + coded.indices.to_numpy()
        if rest:
            pairs.sort()
        # Counted in order of first occurrence, so the pairs of a text stay together.
        counted = pc.value_counts(pa.array(pairs))
        pairs, counts = counted.field(0).to_numpy(), counted.field(1).to_numpy()
        return distinct, *np.divmod(pairs, max(1, len(distinct))), counts


# U+0130 becomes two code points in lower case.
_BEYOND = re.compile(f"[İ{chr(PLAIN_LIMIT)}-\U0010ffff]")


def _strings(values: pa.Array) -> list[str]:
    # Several times faster than to_pylist().
    return values.to_numpy(zero_copy_only=False).tolist()


def key_of(word: str) -> str:
    """The word, or a digest with a blank in front where it is long; no word holds a blank."""
    # A character has four bytes at most.
    if len(word) * 4 <= KEY_BYTES or len(spelled := word.encode()) <= KEY_BYTES:
        return word
    return " " + hashlib.sha256(spelled).hexdigest()


_NO_MODEL = {"type": "BPE", "vocab": {}, "merges": []}


def cutting_only(described: str) -> str:
    """The description without vocabulary and merges, which cutting does not need."""
    return json.dumps(json.loads(described) | {"model": _NO_MODEL})


@lru_cache(maxsize=1)
def _cutter(described: str) -> Cutter:
    return Cutter(described)


@lru_cache(maxsize=1)
def piece_counter(described: str) -> Callable[[list[str]], list[int]]:
    """A function that counts the pieces of pre-tokens."""
    spec = json.loads(described)
    spec["normalizer"], spec["added_tokens"] = None, []
    spec["pre_tokenizer"] = spec["pre_tokenizer"]["pretokenizers"][-1]
    library = Tokenizer.from_str(json.dumps(spec))
    return lambda words: [len(e) for e in library.encode_batch_fast(words, add_special_tokens=False)]


def _described(path: str) -> str:
    """The tokenizer's description, without truncation and padding."""
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library.to_str()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of batches, with about ``_SLICE`` characters of text (column 0) at a time."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False))
        low = 0
        while low < batch.num_rows:
            before = sizes[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(sizes, before + _SLICE, side="right")))
            yield batch.slice(low, high - low)
            low = high


def pre_tokens(docs: DataFrame, described: str, text: str = "text") -> DataFrame:
    """(key, word, n): distinct pre-tokens of the texts with their counts; word null where it is the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held = _cutter(described), Counter()

        def passed_on() -> pa.RecordBatch:
            keys = list(map(key_of, held))
            words = [None if k == w else w for k, w in zip(keys, held, strict=True)]
            arrays = [pa.array(keys, pa.string()), pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["key", "word", "n"])

        for part in _slices(batches):
            texts = [cutter.marked(t)[0] for t in _strings(part.column(0))]
            distinct, _, word, counts = cutter.frequencies(texts)
            totals = np.bincount(word, counts, len(distinct)).astype(np.int64)
            for w, n in zip(distinct, totals.tolist(), strict=True):
                held[w] += n
            if len(held) > _HELD:
                yield passed_on()
        if held:
            yield passed_on()

    texts = docs.select(whole_text(text).alias("text")).where("text <> ''")
    counted = texts.mapInArrow(run, "key string, word string, n bigint")
    return counted.groupBy("key").agg(F.max("word").alias("word"), F.sum("n").alias("n"))


def with_pieces(words: DataFrame, described: str) -> DataFrame:
    """(key, n, pieces): the pieces of each distinct pre-token, counted once."""
    shared = words.sparkSession.sparkContext.broadcast(described)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = piece_counter(shared.value)
        for batch in batches:
            made = count(_strings(pc.coalesce(batch.column(1), batch.column(0))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(made, pa.int64())], ["key", "n", "pieces"]
            )

    return words.select("key", "word", "n").mapInArrow(run, "key string, n bigint, pieces bigint")


# Steps of the grid of counts in which the least common count is sought, per doubling.
_GRID = 16


def common_words(pieces: DataFrame, most: int = COMMON) -> tuple[dict[str, int], float]:
    """Pieces of the most frequent pre-tokens, at most ``most``, and the least step they have.

    The step is found by counting pre-tokens in steps of their frequency, of
    which there are about a thousand whatever the input.
    """
    step = F.floor(F.log2("n") * _GRID).cast("int")
    found = pieces.groupBy(step.alias("step")).count().collect()
    least, total = float("inf"), 0
    for row in sorted(found, key=lambda r: -r["step"]):
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least == float("inf"):
        return {}, least
    rows = pieces.where(step >= int(least)).select("key", "pieces").toArrow()
    return dict(zip(_strings(rows["key"]), rows["pieces"].to_pylist(), strict=True)), least


def _looked_up(docs: DataFrame, described: str, common: dict[str, int], carried: list[str], text: str) -> DataFrame:
    """One row a document: pieces of common pre-tokens, and keys and counts of the others."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = _cutter(described), shared.value
        row = TaskContext.get().partitionId() << 40
        for part in _slices(batches):
            marked = [cutter.marked(t) for t in _strings(part.column(0))]
            distinct, of_text, word, counts = cutter.frequencies([t for t, _ in marked])
            keys = list(map(key_of, distinct))
            pieces = np.array([known.get(k, -1) for k in keys], np.int64)
            here = pieces[word] >= 0
            sums = np.zeros(len(marked), np.int64)
            np.add.at(sums, of_text[here], pieces[word[here]] * counts[here])
            sums += np.array([n for _, n in marked], np.int64)
            ends = np.cumsum(np.bincount(of_text[~here], minlength=len(marked)))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            rest = pc.take(pa.array(keys, pa.string()), pa.array(word[~here]))
            made = [
                pa.array(row + np.arange(len(marked))),
                pa.array(sums),
                pa.ListArray.from_arrays(offsets, rest),
                pa.ListArray.from_arrays(offsets, pa.array(counts[~here].astype(np.int64))),
            ]
            row += len(marked)
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], [*part.schema.names[1:], *_ADDED])

    given = docs.select(whole_text(text).alias("_token_text"), *carried)
    kinds = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in carried)
    made = "_token_row bigint, _token_sum bigint, _token_keys array<string>, _token_counts array<bigint>"
    return given.mapInArrow(run, f"{kinds + ', ' if kinds else ''}{made}")


_ADDED = ("_token_row", "_token_sum", "_token_keys", "_token_counts")


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    text: str = "text",
    carried: tuple[str, ...] = ("doc_id",),
    common: int = COMMON,
) -> DataFrame:
    """One row for each row of the documents: the carried columns and ``n_tokens``.

    ``tokenizer`` is the path of a description whose pre-tokens are spelled as
    bytes; special strings inside a text count one each, as by the library's
    default, and none is added at its ends.  Null and empty texts have no tokens,
    repeated rows count each, and very long texts or pre-tokens are counted whole
    (pre-tokens beyond ``KEY_BYTES`` are joined by their SHA-256).  Other columns
    are not read; an empty table gives no rows.
    """
    described = _described(tokenizer or public_tokenizers.path(TOKENIZER))
    cutting = cutting_only(described)
    _cutter(cutting)  # refuses a tokenizer of another kind before any job runs
    pieces = saved(with_pieces(pre_tokens(docs, cutting, text), described), "pre-tokens")
    known, least = common_words(pieces, common)
    rows = saved(_looked_up(docs, cutting, known, list(carried), text), "document-tokens")
    rare = pieces
    if known:
        rare = pieces.where(F.floor(F.log2("n") * _GRID) < int(least))
    pairs = rows.where(F.size("_token_keys") > 0).select(
        "_token_row", F.explode(F.arrays_zip("_token_keys", "_token_counts")).alias("pair")
    )
    rest = (
        pairs.select("_token_row", F.col("pair._token_keys").alias("key"), F.col("pair._token_counts").alias("times"))
        .join(rare.select("key", "pieces"), "key")
        .groupBy("_token_row")
        .agg(F.sum(F.col("times") * F.col("pieces")).alias("_token_rest"))
    )
    total = F.col("_token_sum") + F.coalesce("_token_rest", F.lit(0))
    return rows.join(rest, "_token_row", "left").select(*carried, total.cast("bigint").alias("n_tokens"))
