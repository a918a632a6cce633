"""Where jobs put written intermediates and streaming checkpoints.

On a cluster the folder is the shared one named by ``spark.checkpoint.dir``.
A private temporary folder is used only for local sessions without that
setting (tests, notebooks).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="snapmart-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder name below the shared root."""
    return f"{shared_root(spark)}/snapmart/{label}-{uuid.uuid4().hex}"
