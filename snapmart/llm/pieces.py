"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

A text becomes marked words: blanks turn into the mark U+2581, a mark is put in
front, and the text is cut where no piece of the vocabulary can reach across,
i.e. before each run of marks and around line breaks.  The distinct marked
words of a batch are sorted; taken in that order they are the leaves of a trie
met depth-first, and the forward states of a common prefix are kept from one
word to the next.

The forward state of a prefix is its last piece, whose length says which shorter
prefix comes before it; ids are put together once at the end of a word, so memory
is linear in the length of a word.  The vocabulary is of the merging kind (byte-pair encoding), for which the segmentation with the
highest sum of scores is not the library's.  A segmentation is the one that
merging gives exactly if merging leaves each pair of neighbouring pieces as it
is, so the step of the recursion only admits a piece after a state whose last
piece it does not merge with; one path remains, the library's own ids.

Models are read from a file on the driver and sent to the tasks; their size is
that of the vocabulary.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Marked words that a task remembers, twice over, their characters, and pairs of pieces whose
# merging it remembers.
_CACHE_WORDS = 100_000
_CACHE_CHARS = 2_500_000
_CACHE_PAIRS = 250_000
# Characters at the end of a piece by which the lengths of possible pieces are known.
_TAIL = 3
_SHORT = range(_TAIL - 1, 1, -1)
# Characters of texts that are cut into words at a time, and words of one longer text.
_HELD_CHARS = 1_000_000
_HELD_WORDS = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that merging can make, with ids and scores, and the ids of bytes."""

    pieces: dict[str, tuple[str, bytes]]  # each piece with its id as four bytes
    scores: dict[str, float]
    tails: dict[str, tuple[int, ...]]  # lengths of the pieces that end in three characters, longest first
    byte_ids: list[int]
    texts: list[bytes]  # what each id decodes to

    @classmethod
    def load(cls, path: str = MODEL_FILE) -> Vocabulary:
        """Read a model file."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found, scores, texts, tails = {}, {}, [], defaultdict(set)
        byte_ids = [model.unk_id()] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                found[piece] = (piece, np.int32(i).tobytes())
                scores[piece] = model.get_score(i)
                if len(piece) >= _TAIL:
                    tails[piece[-_TAIL:]].add(len(piece))
                texts.append(piece.replace(MARK, " ").encode())
        inner = [p for p in found if re.search(f"[^{MARK}]{MARK}|\n", p)]
        if inner:
            raise ValueError(f"pieces reach across words: {inner[:3]}")
        tails = {tail: tuple(sorted(lengths, reverse=True)) for tail, lengths in tails.items()}
        return cls(found, scores, tails, byte_ids, texts)


@dataclass
class Encoder:
    """Encodes marked words, sharing the work of common prefixes."""

    vocabulary: Vocabulary
    words: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)  # those before; a word that comes again moves up
    pairs: dict[tuple[str, str], bool] = field(default_factory=dict)
    steps: int = 0  # forward steps taken
    chars: int = 0  # characters of the words remembered

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge neighbours, the highest score first, from the left, until none is a piece."""
        scores = self.vocabulary.scores
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def apart(self, left: str, right: str) -> bool:
        """Whether merging makes and keeps two neighbouring pieces (or one at the start)."""
        if len(self.pairs) >= _CACHE_PAIRS:
            self.pairs.clear()
        apart = self.merged(list(left + right)) == [p for p in (left, right) if p]
        self.pairs[left, right] = apart
        return apart

    def learn(self, words: set[str]) -> None:
        """Encode new marked words in sorted order, from the states of the common prefix on."""
        known, pairs, tails = self.vocabulary.pieces, self.pairs, self.vocabulary.tails
        # Forward states of the current word's prefixes: the last piece, and its ids.
        last: list[str] = [""]
        codes: list[bytes] = [b""]
        before = ""
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], codes[shared + 1 :]
            self.steps += len(word) - shared
            for end in range(shared + 1, len(word) + 1):
                # Only one piece fits; most often it is the last one and one more character.
                start = end - 1 - len(last[end - 1])
                found = known.get(word[start:end])
                if found is not None and pairs.get((last[start], found[0])):
                    last.append(found[0])
                    codes.append(found[1])
                    continue
                sizes = tails.get(word[end - _TAIL : end], ()) if end >= _TAIL else ()
                for size in (*sizes, *_SHORT):
                    if size > end:
                        continue
                    found = known.get(word[end - size : end])
                    if found is not None:
                        before_it = last[end - size]
                        apart = pairs.get((before_it, found[0]))
                        if apart is None:
                            apart = self.apart(before_it, found[0])
                        if apart:
                            break
                else:
                    found = known.get(word[end - 1])
                    if found is None:
                        found = (word[end - 1], self._spelled(word[end - 1]))
                last.append(found[0])
                codes.append(found[1])
            before = word
            made, end = [], len(word)
            while end:
                made.append(codes[end])
                end -= len(last[end])
            made.reverse()
            self.words[word] = b"".join(made)
            self.chars += len(word)

    def _spelled(self, char: str) -> bytes:
        """Ids of a character that is no piece, from its bytes."""
        return np.array([self.vocabulary.byte_ids[b] for b in char.encode()], np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text; None for None.  Few words are held at a time."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            if text is None:
                continue
            if len(text) > _HELD_CHARS:
                words = map(re.Match.group, _WORD.finditer(_marked(text)))
                parts = iter(lambda: list(islice(words, _HELD_WORDS)), [])  # noqa: B023
                out[i] = np.concatenate([self._look_up([part])[0] for part in parts])
                continue
            group.append(i)
            held += len(text)
            if held > _HELD_CHARS:
                self._fill(out, texts, group)
                group, held = [], 0
        self._fill(out, texts, group)
        return out

    def _fill(self, out: list, texts: list, group: list[int]) -> None:
        found = self._look_up([marked_words(texts[i]) for i in group])
        for i, ids in zip(group, found, strict=True):
            out[i] = ids

    def _look_up(self, cut: list[list[str]]) -> list[np.ndarray]:
        if len(self.words) > _CACHE_WORDS or self.chars > _CACHE_CHARS:
            self.older, self.words, self.chars = self.words, {}, 0
        new = {w for words in cut for w in words if w not in self.words}
        again = new & self.older.keys()
        self.words.update((w, self.older[w]) for w in again)
        self.chars += sum(map(len, again))
        self.learn(new - again)
        look = self.words.__getitem__
        return [np.frombuffer(b"".join(map(look, words)), np.int32) for words in cut]


_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def _marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def marked_words(text: str) -> list[str]:
    """The marked words of a text, in order; none for an empty text."""
    return _WORD.findall(_marked(text))


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of a sequence of ids, without the blank that encoding put in front."""
    text = b"".join([vocabulary.texts[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


# Rows of a batch that are converted, and passed on, together.
_ROWS = 256


def _mapped(docs: DataFrame, model_file: str, column: str, out: list[T.StructField], convert):
    """All columns of the rows and some more, made from a column by a function of arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))
    made_names = [f.name for f in out]
    carried = [c for c in docs.columns if c not in made_names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = convert(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *task(part.column(0))],
                    [*part.schema.names[1:], *made_names],
                )

    schema = T.StructType([*(docs.schema[c] for c in carried), *out])
    return docs.select(F.col(column).alias("_piece_input"), *carried).mapInArrow(run, schema)


def _id_lists(found: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if f is None else len(f) for f in found]
    flat = np.concatenate([np.zeros(0, np.int32), *(f for f in found if f is not None)])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    none = pa.array([f is None for f in found], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=none)


def _ids_field(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType()))


def encoded(
    docs: DataFrame, model_file: str = MODEL_FILE, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Adds the ids of a text as array<int>: null for null, empty for empty.

    A character without a piece is encoded as its UTF-8 bytes.  Repeated rows
    are encoded each, a column named like the result is replaced, and an empty
    table gives no rows.
    """

    def convert(vocabulary: Vocabulary):
        encoder = Encoder(vocabulary)
        return lambda texts: [_id_lists(encoder.encode(texts.to_pylist()))]

    return _mapped(docs, model_file, text, [_ids_field(out)], convert)


def decoded(
    docs: DataFrame, model_file: str = MODEL_FILE, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Adds the text of a column of ids: null for null, empty for none.

    It equals the encoded text, except that U+2581 in a text comes back as a
    blank, as in the library.
    """

    def convert(vocabulary: Vocabulary):
        def task(lists: pa.Array) -> list[pa.Array]:
            values = [np.asarray(x.values, np.int32) if x.is_valid else None for x in lists]
            return [pa.array([None if v is None else decode(vocabulary, v) for v in values], pa.string())]

        return task

    return _mapped(docs, model_file, ids, [T.StructField(out, T.StringType())], convert)


def encoded_and_decoded(
    docs: DataFrame,
    model_file: str = MODEL_FILE,
    text: str = "text",
    ids: str = "ids",
    out: str = "decoded",
) -> DataFrame:
    """:func:`encoded`, then :func:`decoded` on its ids, in one pass over the rows."""

    def convert(vocabulary: Vocabulary):
        encoder = Encoder(vocabulary)

        def task(texts: pa.Array) -> list[pa.Array]:
            found = encoder.encode(texts.to_pylist())
            back = [None if f is None else decode(vocabulary, f) for f in found]
            return [_id_lists(found), pa.array(back, pa.string())]

        return task

    return _mapped(docs, model_file, text, [_ids_field(ids), T.StructField(out, T.StringType())], convert)
