"""I-Match fingerprints against a plain version with the same hash."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import xxhash

from snapmart.llm import fingerprints as fp


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def array_hash(values):
    """Spark's xxhash64 of an array of longs: the hash so far seeds the next."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), h)
    return f"{h:016x}"[-fp.HASH_DIGITS :]


def plain_terms(text):
    line = (text or "").lower()
    for blank in "\t\n\x0b\x0c\r":
        line = line.replace(blank, " ")
    return {signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in line.split(" ") if t}


def subset(h, tier):
    return (h >> fp._SHIFTS[tier]) % fp.TIERS[tier][0]


def plain_print(terms, lexicon):
    drawn = {h for h in terms if any(subset(h, i) < fp.TIERS[i][1] for i in range(2))}
    kept = (drawn & lexicon) or drawn
    if terms and not kept:
        return [array_hash(sorted(terms))] + [fp.EMPTY] * (sum(c for _, c in fp.TIERS) - 1)
    out, low = [], (1 << fp._TERM_BITS) - 1
    for tier, (_, count) in enumerate(fp.TIERS):
        for k in range(count):
            own = sorted(k << fp._TERM_BITS | (h & low) for h in kept if subset(h, tier) == k)
            out.append(array_hash(own) if own else fp.EMPTY)
    return out


def plain_likeness(a, b):
    cut = fp.TIERS[0][1]
    said = []
    for x, y in ((a[:cut], b[:cut]), (a[cut:], b[cut:])):
        said.append([p == q for p, q in zip(x, y, strict=True) if not p == q == fp.EMPTY])
    coarse, fine = said
    if not coarse and not fine:
        return 1.0
    best = fine if len(fine) >= fp.ENOUGH or not coarse else coarse
    return sum(best) / len(best)


def plain(rows):
    """Rows by descending id, nulls last, equal ids by descending text."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    texts = [r[1] or "" for r in ordered]
    df = Counter(t for text in texts for t in plain_terms(text))
    n = len(texts)
    lexicon = {t for t, c in df.items() if fp.MIN_IDF <= math.log(n / c) <= fp.MAX_IDF}
    prints = [plain_print(plain_terms(t), lexicon) for t in texts]
    out = []
    for i, (text, own) in enumerate(zip(texts, prints, strict=True)):
        after = (i + 1) % n
        k = len(text) // 3
        edited = text[: len(text) - k] + texts[after][:k]
        changed = plain_print(plain_terms(edited), lexicon)
        out.append((
            ordered[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own),
            "".join(changed), plain_likeness(own, changed), plain_likeness(own, prints[after]),
        ))
    return out


def compare(frame, rows):
    assert frame.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    got = sorted((tuple(r) for r in frame.collect()), key=repr)
    assert got == sorted(plain(rows), key=repr)
    return got


def test_given_documents(given):
    got = compare(fp.edited_fingerprints(given), [tuple(r) for r in given.select("doc_id", "text").collect()])
    assert sum(r[5] > r[6] for r in got) > 0.8 * len(got)


def test_awkward_documents(documents, awkward):
    compare(fp.edited_fingerprints(documents(awkward)), [(r[0], r[1]) for r in awkward])
    assert fp.edited_fingerprints(documents([])).collect() == []


def test_one_document_is_its_own_neighbour(documents):
    (row,) = compare(fp.edited_fingerprints(documents([(5, "abc def ghi")])), [(5, "abc def ghi")])
    assert row[6] == 1.0


def test_equal_texts_have_equal_fingerprints(documents):
    docs = [(i, "same words in the same order here") for i in range(5)] + [(9, "other words"), (10, None)]
    got = compare(fp.edited_fingerprints(documents(docs)), docs)
    assert len({r[3] for r in got if r[0] < 5}) == 1 and len({r[3] for r in got}) == 3


def _mostly_one_group(group):
    """A third of all rows from one group, the others with terms of their own."""
    rng = random.Random(3)
    rest = [(1000 + i, " ".join(f"w{rng.randrange(4000)}" for _ in range(150))) for i in range(80)]
    return group + rest


def test_copies_do_not_make_their_terms_common(documents):
    text = " ".join(f"copied{k}" for k in range(300))
    docs = documents(_mostly_one_group([(i * 30 + 1, text) for i in range(40)]))
    got = [r for r in fp.edited_fingerprints(docs).collect() if r["doc_id"] % 30 == 1 and r["doc_id"] < 1200]
    assert len(got) >= 40 and min(r["near_edited"] for r in got if r["n_chars"] == len(text)) > 0
    assert {r["near_next"] for r in got if r["doc_id"] <= 1000 and r["doc_id"] > 1} == {1.0}


def test_near_copies_in_a_large_group_are_alike(documents):
    words = [f"near{k}" for k in range(400)]
    group = [(i, " ".join(words + [f"more{i}x{k}" for k in range(4)])) for i in range(40)]
    rows = fp.edited_fingerprints(documents(_mostly_one_group(group))).collect()
    near = [r["near_next"] for r in rows if 0 < r["doc_id"] < 40]
    assert len(near) == 39 and sum(near) / len(near) > 0.7
    # A third of the terms is gone: some subset without them is left for most texts.
    assert sum(r["near_edited"] > 0 for r in rows if r["doc_id"] < 40) > 20
