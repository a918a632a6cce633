"""Line dedup against a plain scan of all windows of all documents."""

from __future__ import annotations

import random

import xxhash

from snapmart.llm import line_dedup


def plain(docs, least):
    """Texts without runs of at least ``least`` words that an earlier place has."""
    order = sorted(
        range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0)
    )
    seen: dict[tuple, tuple] = {}
    out = {}
    first_place = {}
    for i in order:
        lines = [x.strip() for x in (docs[i][1] or "").split("\n")]
        at = [k for k, x in enumerate(lines) if x.split()]
        for a in range(len(at)):
            words = 0
            for b in range(a, len(at)):
                words += len(lines[at[b]].split())
                if words >= least:
                    run = tuple(lines[at[k]] for k in range(a, b + 1))
                    first_place.setdefault(run, (i, a))
                    break
    for i, (_, text) in enumerate(docs):
        lines = (text or "").split("\n")
        bare = [x.strip() for x in lines]
        at = [k for k, x in enumerate(bare) if x.split()]
        dead = set()
        for a in range(len(at)):
            words = 0
            for b in range(a, len(at)):
                words += len(bare[at[b]].split())
                if words < least:
                    continue
                run = tuple(bare[at[k]] for k in range(a, b + 1))
                j, c = first_place[run]
                if (j, c) != (i, a):
                    other = [x.strip() for x in docs[j][1].split("\n")]
                    other = [x for x in other if x.split()]
                    own = [bare[k] for k in at]
                    lo, hi = 0, 0
                    while lo < least and a - lo > 0 and c - lo > 0 and own[a - lo - 1] == other[c - lo - 1]:
                        lo += 1
                    n = b - a + 1
                    while (
                        hi < least and b + 1 + hi < len(own) and c + n + hi < len(other)
                        and own[b + 1 + hi] == other[c + n + hi]
                    ):
                        hi += 1
                    dead |= set(range(at[a - lo], at[b + hi] + 1))
                break
        out[i] = text if not dead else "\n".join(x for k, x in enumerate(lines) if k not in dead)
    return out


def run(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def passages(rng, n):
    return [
        [" ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randrange(4, 30))) for _ in range(rng.randrange(1, 6))]
        for _ in range(n)
    ]


def test_random_documents_with_shared_passages(documents):
    rng = random.Random(3)
    shared = passages(rng, 8)
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            lines += rng.choice(shared) if rng.random() < 0.5 else passages(rng, 1)[0]
            if rng.random() < 0.3:
                lines.append(rng.choice(["", "  ", "footer line"]))
        docs.append((i, "\n".join(lines)))
    want = plain(docs, 50)
    got = dict(run(line_dedup.dedup_lines(documents(docs))))
    assert got == {i: want[i] for i in got}
    assert sum(got[i] != docs[i][1] for i in got) > 10


def test_given_documents(given):
    rows = [(r["doc_id"], r["text"]) for r in given.select("doc_id", "text").collect()]
    want = plain(rows, 50)
    got = dict(run(line_dedup.dedup_lines(given)))
    assert got == {rows[i][0]: t for i, t in want.items()}


def test_passage_inside_clean_documents(documents):
    passage = " ".join(f"word{i}" for i in range(60))
    docs = [(9, f"own nine\n{passage}\nend nine"), (4, f"start four\n {passage} "), (5, "clean text"), (None, passage)]
    got = dict(run(line_dedup.dedup_lines(documents(docs))))
    assert got == {9: "own nine\nend nine", 4: f"start four\n {passage} ", 5: "clean text", None: ""}


def test_runs_repeat_inside_a_document(documents):
    passage = "\n".join(" ".join(f"w{i}-{j}" for i in range(20)) for j in range(3))
    (row,) = run(line_dedup.dedup_lines(documents([(1, f"{passage}\nmiddle\n{passage}\nlast")])))
    assert row == (1, f"{passage}\nmiddle\nlast")


def test_awkward_documents(documents, awkward):
    frame = line_dedup.dedup_lines(documents(awkward))
    assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(run(frame), key=repr) == sorted([(r[0], r[1]) for r in awkward], key=repr)
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_clashing_columns(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    frame = spark.createDataFrame(
        [(1, passage, 7, "x"), (2, passage, 8, "y")], "doc_id int, text string, start int, mark string"
    )
    got = sorted(map(tuple, line_dedup.dedup_lines(frame).collect()))
    assert got == [(1, passage, 7, "x"), (2, "", 8, "y")]


def test_fingerprints_are_the_minima_of_windows():
    rng = random.Random(5)
    lines = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    found = list(line_dedup.fingerprints("\n".join(lines).encode(), 50))
    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    spans = [(w["start"], w["end"]) for _, _, ws in found for w in ws]
    assert [a for a, _ in spans] == list(range(len(spans)))
    for least, around, ws in found:
        for w in ws:
            assert signed(min(hashes[w["start"] : w["end"]])) == least
            inside = [signed(h) for h in hashes[w["start"] : w["end"]]]
            assert around[w["first"] : w["behind"]] == inside
            assert sum(len(x.split()) for x in lines[w["start"] : w["end"]]) >= 50
    assert 0 < len(found) < len(spans) / 2


def test_equal_rows_are_one_document(documents):
    rng = random.Random(6)
    text = "\n".join(" ".join(f"w{rng.randrange(999)}" for _ in range(9)) for _ in range(40))
    seen = lambda n: sorted(map(repr, line_dedup.shared_windows(
        documents([(1, text)] * n + [(None, text)] * n + [(2, text)])
    ).collect()))
    assert seen(1) == seen(2_000)
    got = run(line_dedup.dedup_lines(documents([(1, text)] * 500 + [(None, text)] * 500 + [(2, text)])))
    assert sorted(got, key=repr) == sorted([(1, text)] * 500 + [(None, "")] * 500 + [(2, "")], key=repr)


def test_a_line_of_every_text_costs_no_run(documents):
    """A line that all texts share is a fingerprint of many, and no run of 50 words."""
    rng = random.Random(8)
    footer = "all rights reserved"
    docs = []
    for i in range(300):
        own = [" ".join(f"d{i}-{rng.randrange(999)}" for _ in range(12)) for _ in range(12)]
        docs.append((i, "\n".join(x for line in own for x in (line, footer))))
    assert sorted(run(line_dedup.dedup_lines(documents(docs)))) == docs
