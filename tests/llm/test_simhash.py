"""SimHash near-duplicates against a plain fingerprint and all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash

from snapmart.llm import links, simhash


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, ids, max_bits=2):
    """Smallest id reachable, over all pairs."""
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(sorted(set(prints)), 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(a)] = find(b)
    least = {}
    for p, i in zip(prints, ids, strict=True):
        r = find(p)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(find(p)) for p in prints]


def test_given_documents(given):
    rows = given.select("doc_id", "text").collect()
    prints = [plain(r["text"]) for r in rows]
    want = groups(prints, [r["doc_id"] for r in rows])
    near = simhash.near_duplicates(given)
    got = {r[0]: (r[1], r[2]) for r in near.select("doc_id", simhash.hex_text("fp"), "component_id").collect()}
    assert got == {r["doc_id"]: (f"{p:016x}", c) for r, p, c in zip(rows, prints, want, strict=True)}
    assert len(set(want)) < len(want)


def test_awkward_documents(documents, awkward):
    near = simhash.near_duplicates(documents(awkward)).collect()
    prints = [plain(r[1]) for r in awkward]
    want = groups(prints, [r[0] for r in awkward])
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    assert sorted(map(tuple, near), key=repr) == sorted(
        zip([r[0] for r in awkward], signed, want, strict=True), key=repr
    )
    assert simhash.near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize(("segments", "max_bits"), [(3, 2), (2, 1), (4, 3), (3, 0)])
def test_no_link_is_lost(spark, segments, max_bits):
    rng = random.Random(segments * 10 + max_bits)
    prints = set()
    for _ in range(40):
        seed = rng.getrandbits(64)
        for _ in range(12):
            prints.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))))
    prints |= {0, (1 << 64) - 1, 1, 1 << 63}
    want = {
        (min(map(simhash._signed, p)), max(map(simhash._signed, p)))
        for p in combinations(prints, 2)
        if (p[0] ^ p[1]).bit_count() <= max_bits
    }
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp bigint")
    got = [tuple(r) for r in simhash.linked(frame, max_bits, segments).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_two_bits_take_22_probes_a_table():
    flips = simhash.probe_masks(3, 2)
    assert all(len(f) in (22, 23) for f in flips)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 170)]
    star = [(5, 200 + i) for i in range(60)]
    edges = spark.createDataFrame(chain + star, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in links.components(edges).collect()}
    assert found == {**{i: 100 for i in range(100, 171)}, 5: 5, **{200 + i: 5 for i in range(60)}}


def test_one_document_of_each_group_stays(documents, awkward):
    kept = simhash.keep_one(documents(awkward))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # The two rows of id 1 are copies; blank, empty and null texts are copies of id 2.
    assert ids == sorted([1, 2, None, 5, 6, 7], key=repr)
    assert simhash.keep_one(documents([])).count() == 0
