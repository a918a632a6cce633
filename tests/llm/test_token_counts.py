"""Token counts against the library's own encoding of whole texts."""

from __future__ import annotations

import json

import public_tokenizers
import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapmart.llm import token_counts as tc

PATH = public_tokenizers.path(tc.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def described():
    return tc._described(PATH)


def counts(frame, **options):
    rows = tc.token_counts(frame, carried=("doc_id", "text"), **options).collect()
    return sorted(((r["doc_id"] is None, r["doc_id"], r["text"] or "", r["n_tokens"]) for r in rows), key=repr)


def wanted(library, rows):
    return sorted(
        ((i is None, i, t or "", len(library.encode(t or "", add_special_tokens=False))) for i, t in rows), key=repr
    )


@pytest.mark.parametrize("common", [tc.COMMON, 40, 0])
def test_given_documents(library, given, common):
    rows = [(r["doc_id"], r["text"]) for r in given.collect()]
    assert counts(given, common=common) == wanted(library, rows)


def test_awkward_documents(library, documents, awkward):
    texts = [
        "<|startoftext|>a<|endoftext|> <|ENDOFTEXT|> <|endoftext|", "it's I'LL 'sx ''s .'s 'rex's' 'd", "İstanbul ΣΑΣ ſ ŉ",
        "é <|endoftext|>́", "x" * 5000, "=" * 300 + "a" * 300, "\x1c\x85\xa0 　 ½²³12", "漢字" * 50, "-" * 64, "-" * 65,
    ]
    rows = awkward + [(i, t, None, None, None) for i, t in enumerate(texts * 2, 100)]
    assert counts(documents(rows), common=5) == wanted(library, [r[:2] for r in rows])
    assert tc.token_counts(documents([])).collect() == []


def test_columns_that_clash(library, documents):
    frame = documents([(1, "one two", "en", "s", 9)]).withColumnsRenamed({"lang": "n", "source": "key"})
    rows = tc.token_counts(frame, carried=("doc_id", "n", "key")).collect()
    assert [tuple(r) for r in rows] == [(1, "en", "s", 2)]


def test_every_code_point_of_the_tables(library, described):
    cutter, count = tc.Cutter(described), tc.piece_counter(described)
    chars = [chr(c) for c in range(1, tc.PLAIN_LIMIT) if cutter.is_plain(chr(c))]
    texts = [f"a{c}b {c} {c}{c}'s{c} 1{c}1 '{c}" for c in chars]
    words, of_text = cutter.cut_plain(texts)
    found = [0] * len(texts)
    for n, i in zip(count(words.to_pylist()), of_text.tolist(), strict=True):
        found[i] += n
    assert found == [len(library.encode(t, add_special_tokens=False)) for t in texts]


@settings(max_examples=300, deadline=None)
@over(texts=st.lists(st.text(st.sampled_from(list("aestrlmvdS'' .1é²\n Σ漢́")), max_size=30), min_size=1, max_size=5))
def test_random_texts(library, described, texts):
    cutter, count = tc._cutter(described), tc.piece_counter(described)
    distinct, of_text, word, times = cutter.frequencies(texts)
    pieces = count(distinct)
    found = [0] * len(texts)
    for i, w, n in zip(of_text.tolist(), word.tolist(), times.tolist(), strict=True):
        found[i] += n * pieces[w]
    assert found == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_common_words_are_bounded_and_the_most_frequent(spark):
    frame = spark.createDataFrame([(f"w{i}", 1 + i % 50, i % 3) for i in range(500)], "key string, n bigint, pieces bigint")
    known, least = tc.common_words(frame, 100)
    assert 0 < len(known) <= 100
    assert {f"w{i}" for i in range(500) if 1 + i % 50 >= 45} <= set(known)
    assert tc.common_words(frame.limit(0)) == ({}, float("inf"))


def test_pieces_are_counted_once_for_each_pre_token(spark, documents, described):
    frame = documents([(i, "same words again and again") for i in range(50)])
    words = tc.pre_tokens(frame, described)
    assert sorted((r["key"], r["n"]) for r in words.collect()) == [("again", 100), ("and", 50), ("same", 50), ("words", 50)]
    assert tc.with_pieces(words, described).count() == 4


def test_other_kinds_are_refused():
    spec = json.loads(open(PATH).read())
    spec["pre_tokenizer"]["pretokenizers"][-1]["use_regex"] = True
    with pytest.raises(ValueError, match="cuts or adds"):
        tc.Cutter(json.dumps(spec))
