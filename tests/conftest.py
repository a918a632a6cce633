from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from snapmart.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def shared(spark, tmp_path):
    return str(tmp_path)


@pytest.fixture
def one(spark):
    """Evaluate a column over one row of named values given as SQL literals."""

    def evaluate(column, **values):
        row = spark.range(1)
        for name, literal in values.items():
            row = row.selectExpr("*", f"{literal} AS {name}")
        return row.select(column.alias("out")).first()["out"]

    return evaluate
