"""Fill-in-middle texts against a plain version, and the index against its offsets."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st

from snapmart.llm import fill_in_middle as fim

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")


def plainly(doc_id, text):
    """(n, form, output, prefix_chars, middle_chars) by lists of tokens."""
    text = text or ""
    tokens = TOKEN.findall(text)
    key = "" if doc_id is None else doc_id
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", text, None, None
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 20:
        return len(tokens), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(tokens), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def made(frame):
    rows = fim.restored(fim.transformed(frame)).collect()
    for r in rows:
        assert r["fim_restored"] == (r["text"] or "")
    return sorted(
        (r["doc_id"] is None, r["doc_id"], r["text"] or "", r["fim_tokens"], r["fim_form"], r["fim_output"],
         r["fim_prefix_chars"] or -1, r["fim_middle_chars"] or -1)
        for r in rows
    )


def wanted(pairs):
    rows = ((i, t or "", plainly(i, t)) for i, t in pairs)
    return sorted((i is None, i, t, n, f, o, a or -1, b or -1) for i, t, (n, f, o, a, b) in rows)


def test_given_documents(given):
    pairs = [(r["doc_id"], r["text"]) for r in given.collect()]
    assert made(given) == wanted(pairs)
    assert {plainly(*p)[1] for p in pairs} == {"plain", "psm", "spm"}


def test_awkward_rows_and_marks(documents, awkward):
    rows = [r for r in awkward if r[0] is not None] + [
        (i, text, None, None, None)
        for i, text in enumerate(["a<P>b", "<S>", "x <M> y", "<<S", "S><P", "<M", "a<", "M>" * 9, "\x00\n<P"], 100)
    ]
    assert made(documents(rows)) == wanted([r[:2] for r in rows])
    nulls = made(documents([r for r in awkward if r[0] is None]))
    assert [r[3:] for r in nulls] == [r[3:] for r in wanted([r[:2] for r in awkward if r[0] is None])]


def test_columns_pass_through_and_empty_table(documents):
    frame = documents([(1, "a b", "en", "s", 3)]).withColumnRenamed("lang", "fim_output")
    row = fim.transformed(frame).collect()[0]
    assert row["fim_output"] == plainly(1, "a b")[2] and row["n_chars"] == 3
    assert fim.restored(fim.transformed(documents([]))).collect() == []


def test_seed_and_shares(documents):
    frame = documents([(i, f"some words {i}") for i in range(300)])
    assert {r[0] for r in fim.transformed(frame, plain_share=100).select("fim_form").collect()} == {"plain"}
    all_first = fim.transformed(frame, plain_share=0, suffix_first_share=100)
    assert {r[0] for r in all_first.select("fim_form").collect()} == {"spm"}
    one, two = (
        [r[0] for r in fim.transformed(frame, seed=s).orderBy("doc_id").select("fim_output").collect()]
        for s in (1, 2)
    )
    assert one != two


@settings(max_examples=200, deadline=None)
@over(
    steps=st.lists(st.one_of(st.integers(1, 12), st.integers(1, 3000)), min_size=1, max_size=600),
    cuts=st.lists(st.integers(0, 600), max_size=4),
)
def test_index_is_exact_and_bounded(steps, cuts):
    offsets = np.cumsum([0, *steps]).astype(np.int64)
    index = fim.RankIndex()
    for part in np.split(offsets, sorted(c for c in cuts if c < len(offsets))):
        index.add(part)
    index.finish()
    assert index.size == len(offsets)
    assert [index.offset(k) for k in range(len(offsets))] == offsets.tolist()
    assert all(np.abs(r.astype(int)).max() <= fim.ERROR + 1 for r in index.residuals)


def test_regular_offsets_take_one_segment_and_long_ones_more():
    index = fim.RankIndex()
    index.add(np.arange(0, 3 * fim.MAX_SEGMENT, 3))
    assert len(index.finish().starts) == 1
    index = fim.RankIndex()
    index.add(np.arange(5 * fim.MAX_SEGMENT))
    assert len(index.finish().starts) == 5
    assert index.offset(4 * fim.MAX_SEGMENT + 7) == 4 * fim.MAX_SEGMENT + 7


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_blocks_of_long_texts(monkeypatch, block):
    text = "naïve café 漢字🙂x ab1cd\n" * 5 + "zzz" * 40
    monkeypatch.setattr(fim, "_BLOCK", block)
    index = fim._long_index(np.frombuffer(text.encode(), np.uint8))
    ends = [0, *np.cumsum([len(t) for t in TOKEN.findall(text)]).tolist()]
    assert [index.offset(k) for k in range(index.size)] == ends


@settings(max_examples=200, deadline=None)
@over(texts=st.lists(st.text(st.sampled_from("abZ é漢🙂<>PSM\n0"), max_size=40), max_size=6))
def test_batches_of_texts(texts):
    import pyarrow as pa

    ids = list(range(len(texts)))
    found = fim._cuts(pa.array(texts, pa.string()), pa.array([7 * i + 3 for i in ids], pa.int64()), pa.array([5 * i for i in ids], pa.int64()))
    for i, text, (n, begin, size) in zip(ids, texts, found, strict=True):
        tokens = TOKEN.findall(text)
        a, b = sorted(((7 * i + 3) % (len(tokens) + 1), 5 * i % (len(tokens) + 1)))
        assert (n, begin, size) == (len(tokens), len("".join(tokens[:a])), len("".join(tokens[a:b])))
