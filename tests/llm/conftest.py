"""Small tables with the awkward rows every dealt operator must bear."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def given(spark):
    """The documents table of the smallest size."""
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs or whole rows."""

    def make(rows):
        whole = [r if len(r) == 5 else (r[0], r[1], "en", "s", None) for r in rows]
        return spark.createDataFrame(whole, DOCS)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null ids and texts, empty and blank texts, ties, repeated rows, a very long text."""
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()
    long = " ".join(words[(i * i + i // 7) % 10] + str(i % 137) for i in range(30_000))
    return [
        (1, "one two three four five six seven eight nine ten eleven twelve", None, None, None),
        (1, "one two three four five six seven eight nine ten eleven twelve", None, None, None),
        (2, None, "en", "a", 3),
        (3, "", "en", "a", 0),
        (4, " \t\n ", None, "b", 4),
        (None, "some text of a document without an id", "en", None, None),
        (None, None, None, None, None),
        (5, "short", "fr", "b", 5),
        (6, long, "en", "a", len(long)),
        (7, "naïve café — ünïcödé 漢字 🙂🙂 text\nwith lines\nwith lines", "fr", "b", None),
    ]
