"""Captured responses (bronze): reading, routing, decoding, quarantine.

A response is one row ``(platform, keyword, seq, captured_at, url, body)``;
``seq`` is the arrival order, which Spark does not keep by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import settings
from snapmart.functions.variants import (
    decode_json,
    decode_tolerant,
    framed_tolerant,
    has_value,
    in_frame,
    is_single,
    node_at,
    shaped_at,
    without_guard,
)

# The decoder's limit for one body.
MAX_BODY_BYTES = 128 * 1024 * 1024

SCHEMA = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("captured_at", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def read_responses(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Landed responses with the fixed schema (no inference pass)."""
    return spark.read.schema(SCHEMA).format(file_format).load(path)


def read_response_log(spark: SparkSession, path: str) -> DataFrame:
    """Logs ``graphql_<keyword>.json`` with ``=== RESPONSE n ===`` headings.

    A log is one file or a folder of part files.  Records are cut by the reader
    (``lineSep``), so a large log is split over many tasks and is never held as
    a single value.
    """
    lines = spark.read.option("lineSep", "\n=== RESPONSE ").text(path)
    heading = r"^(?:=== RESPONSE )?(\d+) ===\n"
    location = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    name = F.regexp_extract(location, r"[/=]graphql_([^/]*)\.json(?:/[^/]*)?$", 1)
    return lines.where(F.col("value").rlike(heading)).select(
        F.replace(name, F.lit("_"), F.lit(" ")).alias("keyword"),
        F.regexp_extract("value", heading, 1).cast("bigint").alias("seq"),
        F.regexp_replace(F.regexp_replace("value", heading, ""), r"\n+$", "").alias("body"),
    )


def route_posts(responses: DataFrame) -> DataFrame:
    """Search responses of the post site: URL, length, valid JSON, result node.

    The guard is taken off the body that is passed on.
    """
    guard = settings.JSON_GUARDS[0]
    body = F.when(
        F.startswith("body", F.lit(guard)), F.substr("body", F.lit(len(guard) + 1))
    ).otherwise(F.col("body"))
    return (
        responses.where(
            F.contains("url", F.lit(settings.POST_URL_PART))
            & (F.length("body") >= settings.MIN_BODY_CHARS)
        )
        .withColumn("body", body)
        .where(has_value(node_at(decode_json(F.col("body")), "$.data.serpResponse")))
    )


def route_by_url(responses: DataFrame, part: str) -> DataFrame:
    """Responses whose URL contains a fragment."""
    return responses.where(F.contains("url", F.lit(part)))


def undecodable(responses: DataFrame) -> DataFrame:
    """Dead letters: responses no decoding attempt can read, whole, with a ``reason``.

    A bare JSON null counts as unreadable; a body beyond ``MAX_BODY_BYTES`` is
    too long for the decoder.
    """
    body = F.col("body")
    bare_null = F.trim(without_guard(body)) == "null"
    too_long = F.octet_length(body) > MAX_BODY_BYTES
    return responses.where(decode_tolerant(body).isNull() | bare_null).withColumn(
        "reason", F.when(too_long, "too long").otherwise("unreadable")
    )


def bad_records(records: DataFrame, kind: str) -> DataFrame:
    """Records marked with a problem, each as (kind, keyword, seq, pos, problem).

    Response, keyword and place say where the record can be read again.
    """
    name = "keyword" if "keyword" in records.columns else "category"
    return records.where(F.col("problem").isNotNull()).select(
        F.lit(kind).alias("kind"),
        F.col(name).alias("keyword"),
        "seq",
        F.col("pos").cast("bigint").alias("pos"),
        "problem",
    )


def explode_records(
    responses: DataFrame,
    shape: str,
    *paths: str,
    each: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per record: the response columns, ``pos`` in the list and ``record``.

    ``shape`` is the type of a list element; the list is taken from the first
    path where it is not empty.  ``each`` turns an element into the record.
    Responses without records vanish.

    The body is decoded once, in a projection of its own below the generator,
    and a record is one typed value above it: filters on its fields cannot pull
    the decoding or typing in a second time.
    """
    kept = [c for c in responses.columns if c != "body"]
    decoded = responses.select(*kept, framed_tolerant(F.col("body")).alias("_doc"))
    doc = F.col("_doc")
    records = F.lit(None)
    for path in reversed(paths):
        filled = node_at(doc, in_frame(f"{path}[0]")).isNotNull()
        found = shaped_at(doc, in_frame(path), f"array<{shape}>")
        records = F.when(filled, found).otherwise(records)
    records = F.when(is_single(doc), records)
    if each is not None:
        records = F.transform(records, each)
    return decoded.select(*kept, F.posexplode(records).alias("pos", "record"))
