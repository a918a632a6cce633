"""Pieces against the library's own ids, and exact round trips."""

from __future__ import annotations

import random
import tracemalloc

import pytest
import sentencepiece
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st

from snapmart.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary.load())


@settings(max_examples=300, deadline=None)
@over(text=st.text(st.sampled_from(list("aehinorst ▁\n\t.,'ABé漢🙂0")), max_size=60))
def test_random_texts(library, encoder, text):
    encoder.pairs.clear()
    (ids,) = encoder.encode([text])
    assert ids.tolist() == library.encode(text)
    assert pieces.decode(encoder.vocabulary, ids) == library.decode(library.encode(text))


def test_runs_of_blanks_and_repeated_letters(library, encoder):
    rng = random.Random(1)
    texts = [" " * n + "x" for n in range(40)] + ["a" * n for n in range(40)] + ["x" + " " * n for n in range(40)]
    texts += ["".join(rng.choice("abab  ") for _ in range(50)) for _ in range(200)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text)


def test_given_documents(library, given):
    rows = pieces.decoded(pieces.encoded(given)).collect()
    assert len(rows) == given.count()
    for r in rows:
        assert r["ids"] == library.encode(r["text"])
        assert r["decoded"] == r["text"]


def test_prefixes_are_shared(library):
    encoder = pieces.Encoder(pieces.Vocabulary.load())
    words = {pieces.MARK + "inter" + tail for tail in ("", "nation", "national", "nationally", "net")}
    encoder.learn(words)
    prefixes = {w[:e] for w in words for e in range(1, len(w) + 1)}
    assert encoder.steps == len(prefixes) < sum(map(len, words))


def test_awkward_documents(documents, awkward, library):
    rows = pieces.decoded(pieces.encoded(documents(awkward))).collect()
    assert len(rows) == len(awkward)
    for r in rows:
        assert r["ids"] == (None if r["text"] is None else library.encode(r["text"]))
        assert r["decoded"] == r["text"]
    assert pieces.decoded(pieces.encoded(documents([]))).collect() == []
    at_once = pieces.encoded_and_decoded(documents(awkward)).collect()
    assert sorted(at_once, key=repr) == sorted(rows, key=repr)
    assert pieces.encoded_and_decoded(documents([])).collect() == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id int, text string, ids int, decoded string")
    row = pieces.decoded(pieces.encoded(frame)).first()
    assert row["decoded"] == "a b" and row["doc_id"] == 1 and len(row["ids"]) == 2


def test_long_texts_are_cut_in_parts(library, monkeypatch):
    monkeypatch.setattr(pieces, "_HELD_CHARS", 50)
    monkeypatch.setattr(pieces, "_HELD_WORDS", 3)
    monkeypatch.setattr(pieces, "_CACHE_WORDS", 5)
    monkeypatch.setattr(pieces, "_CACHE_PAIRS", 5)
    texts = ["the thing inside the other thing " * n for n in range(6)] + [None, "", "a"]
    found = pieces.Encoder(pieces.Vocabulary.load()).encode(texts)
    assert [None if f is None else f.tolist() for f in found] == [
        None if t is None else library.encode(t) for t in texts
    ]


def test_memory_is_linear_in_the_length_of_a_word(library):
    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    line = "".join(rng.choice(letters) for _ in range(200_000))
    spelled = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(20_000))
    vocabulary = pieces.Vocabulary.load()
    for text in (line, spelled):
        for n in (2_000, len(text)):  # the short one first, as its prefixes took 8 MB or more before
            encoder = pieces.Encoder(vocabulary)
            tracemalloc.start()
            (ids,) = encoder.encode([text[:n]])
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert peak < 1_000_000 + 400 * n
            assert ids.tolist() == library.encode(text[:n])


def test_words_remembered_are_bounded_by_characters(library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHE_CHARS", 100)
    encoder = pieces.Encoder(pieces.Vocabulary.load())
    for k in range(20):
        (ids,) = encoder.encode([f"{k}" * 90])
        assert ids.tolist() == library.encode(f"{k}" * 90)
        assert sum(map(len, encoder.words)) < 400


def test_words_that_come_again_are_not_learned_again(library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHE_WORDS", 6)
    encoder = pieces.Encoder(pieces.Vocabulary.load())
    encoder.encode(["common words come again and"])
    for k in range(20):
        own = f"x{k}y" * 3
        steps, text = encoder.steps, f"common words come again and {own}"
        (ids,) = encoder.encode([text])
        assert ids.tolist() == library.encode(text)
        assert encoder.steps - steps == len(pieces.MARK + own)
        assert len(encoder.words) + len(encoder.older) <= 2 * (6 + 6)
