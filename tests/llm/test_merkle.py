"""Merkle proofs against a plain tree of lists, and what tampering does."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from snapmart.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(nodes, fanout):
    """(root, for each leaf the (place, others) of its levels, lowest first)."""
    steps = [[] for _ in nodes]
    held = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + fanout, len(nodes))) for k in range(0, len(nodes), fanout)]
        for run in runs:
            for k in run:
                for i in held[k]:
                    steps[i].append((k - run[0], [nodes[o] for o in run if o != k]))
        held = [[i for k in run for i in held[k]] for run in runs]
        nodes = [h(*(nodes[k] for k in run)) for run in runs]
    return nodes[0], steps


def plainly(rows, fanout):
    """Sorted (doc_id, leaf, subroot, root, proof) of rows of documents."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted(((r[0], leaf(*r)) for r in rows if r[2] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for lang in langs]
    trees = [tree([d for _, d in g], fanout) for g in groups]
    root, above = tree([t[0] for t in trees], fanout)
    return sorted(
        (
            (doc_id, digest, subroot, root, below + top)
            for g, (subroot, steps), top in zip(groups, trees, above, strict=True)
            for (doc_id, digest), below in zip(g, steps, strict=True)
        ),
        key=repr,
    )


def given_by(made, proved):
    return sorted(
        (
            (r["doc_id"], r["digest"], r["subroot"], made.root, [(s["place"], list(s["others"])) for s in r["proof"]])
            for r in proved.collect()
        ),
        key=repr,
    )


def leaves(frame):
    return frame.select("doc_id", "lang", merkle.digest_of(*(F.col(c) for c in merkle.LEAF_FIELDS)).alias("digest"))


@pytest.mark.parametrize(("fanout", "span"), [(2, 4), (2, 1), (3, 2)])
def test_given_documents(given, fanout, span):
    rows = [tuple(r) for r in given.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    made = merkle.manifest(leaves(given), "lang", ["doc_id"], fanout, span)
    assert given_by(made, merkle.proofs(made, None, fanout, span)) == plainly(rows, fanout)


def test_awkward_documents_and_sizes_of_groups(documents, awkward):
    rows = list(awkward)
    for lang, n in (("l1", 1), ("l2", 2), ("l16", 16), ("l17", 17), ("l33", 33), ("é", 3)):
        rows += [(i, f"text {i}", lang, "s", i) for i in range(1000, 1000 + n)]
    rows += [(9, "same", "en", None, None)] * 40 + [(None, "same", None, None, None)] * 20
    made = merkle.manifest(leaves(documents(rows)), "lang", ["doc_id"])
    assert given_by(made, merkle.proofs(made)) == plainly(rows, 2)


def test_some_requests_get_the_proofs_they_get_among_all(given):
    made = merkle.manifest(leaves(given), "lang", ["doc_id"])
    few = merkle.proofs(made, made.rows.leaves.where("doc_id % 17 = 0"))
    everything = given_by(made, merkle.proofs(made))
    assert given_by(made, few) == [r for r in everything if r[0] % 17 == 0]


def test_one_document_and_none(documents):
    one = merkle.verified_documents(documents([(1, "a", "en", "s", 1)]), F.lit(False)).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"]
    assert list(one["proof"]) == []
    assert merkle.verified_documents(documents([]), F.lit(False)).collect() == []


def test_tampering_is_found_unless_there_is_nothing_to_change(documents, awkward):
    rows = awkward + [(i, "t", "en", "s", i) for i in range(100, 140)] + [(i, "t", "en", "s", None) for i in range(200, 240)]
    rows += [(300, "big", "en", "s", 2**63 - 1)]
    frame = documents(rows).withColumn("digest", F.lit("clash")).withColumn("rank", F.lit(1))
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    for r in merkle.verified_documents(frame.drop("digest"), tampered).collect():
        n_chars = next(x[4] for x in rows if x[0] == r["doc_id"])
        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and n_chars is not None
        assert (r["folded_root"] == r["root"]) is not changed


def test_records_are_addressed_by_content(given):
    made = merkle.manifest(leaves(given), "lang", ["doc_id"])
    for records in made.rows.records:
        for r in records.collect():
            nodes = r["levels"][-1]
            for _ in r["levels"]:
                nodes = [h(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
            assert nodes == [r["digest"]]


def test_no_task_gets_a_group(spark, documents):
    rows = [(i, "t", "en", "s", i) for i in range(4000)]
    placed = merkle.ranked(
        documents(rows).select(F.lit("g").alias("group"), "doc_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("digest")),
        ["doc_id"],
    )
    assert sorted(r["rank"] for r in placed.select("rank").collect()) == list(range(4000))
    assert [r["rank"] for r in placed.orderBy("doc_id").limit(50).collect()] == list(range(50))
