"""Counts, prices, text, categories, filters, times, keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart import settings
from snapmart.functions import numbers, texts, times
from snapmart.operators import filters, keywords
from snapmart.registry import registered, views
from snapmart.registry.views import EVENT_NUMBER_SQL
from snapmart.sources import tables

# Terms that occur in the given texts, to exercise every branch of a dictionary.
SYLLABLES = (
    ("verbs", ("shanin", "nteres", "werden")),
    ("endings", ("lyndre", "ouqueaux")),
    ("articles", ("dasund", "el la", "une en")),
    ("joined", ("andhand", "of the")),
)


def _category_sql(fields: list[str], categories) -> str:
    branches = []
    for name, terms in categories:
        tests = [f"contains({field}, '{term}')" for field in fields for term in terms]
        branches.append(f"WHEN {' OR '.join(tests)} THEN '{name}'")
    return f"CASE {' '.join(branches)} ELSE '{settings.DEFAULT_CATEGORY}' END"


def _classify_posts(spark, sf_dir, categories):
    lowered = views.load(spark, sf_dir, "documents").select(
        "doc_id", F.lower("source").alias("_keyword"), F.lower("text").alias("_text")
    )
    fields = [F.col("_keyword"), F.col("_text")]
    return lowered.select(
        "doc_id",
        texts.category_of(fields, categories, settings.DEFAULT_CATEGORY).alias("category"),
    )


def _classify_posts_sql(categories) -> str:
    return f"""
WITH d AS (SELECT doc_id, lower(source) AS k, lower(text) AS t FROM documents)
SELECT doc_id, {_category_sql(["k", "t"], categories)} AS category FROM d"""


@registered("classify_posts", _classify_posts_sql(settings.POST_CATEGORIES))
def classify_posts(spark, sf_dir):
    return _classify_posts(spark, sf_dir, settings.POST_CATEGORIES)


@registered("classify_posts_other_terms", _classify_posts_sql(SYLLABLES))
def classify_posts_other_terms(spark, sf_dir):
    return _classify_posts(spark, sf_dir, SYLLABLES)


@registered(
    "classify_videos",
    f"""
WITH d AS (SELECT doc_id, lower(lang || ' ' || source || ' ' || text) AS t FROM documents)
SELECT doc_id, {_category_sql(["t"], settings.VIDEO_CATEGORIES)} AS category FROM d""",
)
def classify_videos(spark, sf_dir):
    from snapmart.plans.videos import classified

    records = views.load(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("title"),
        F.col("source").alias("tags"),
        F.col("text").alias("keyword"),
    )
    return classified(records).select("doc_id", "category")


@registered(
    "content_quality",
    """
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_text, CAST(len(a) AS BIGINT) AS n_attachments
FROM (SELECT doc_id, CASE WHEN lang = 'de' THEN '' ELSE text END AS t,
             CASE WHEN source LIKE 'src1%' THEN [source] ELSE [] END AS a FROM documents)
WHERE length(t) > 0 OR len(a) > 0""",
)
def content_quality(spark, sf_dir):
    shaped = views.load(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "de", "").otherwise(F.col("text")).alias("text"),
        F.when(F.startswith("source", F.lit("src1")), F.array("source"))
        .otherwise(F.array().cast("array<string>"))
        .alias("attachments"),
    )
    return filters.with_content(shaped, "text", "attachments").select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_text"),
        F.size("attachments").cast("bigint").alias("n_attachments"),
    )


@registered(
    "exclude_sources",
    """
SELECT doc_id, title FROM (
  SELECT doc_id, CASE lang WHEN 'es' THEN NULL WHEN 'fr' THEN '  ' || upper(source) ELSE source END AS title
  FROM documents) WHERE title IS NULL OR NOT contains(lower(title), 'src1')""",
)
def exclude_sources(spark, sf_dir):
    titled = views.load(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "es", F.lit(None).cast("string"))
        .when(F.col("lang") == "fr", F.concat(F.lit("  "), F.upper("source")))
        .otherwise(F.col("source"))
        .alias("title"),
    )
    return filters.exclude_channels(titled, "title", ["src1"])


def _with_null_keys(spark, sf_dir):
    return views.load(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("post_id"),
        "o_custkey",
        "o_orderstatus",
    )


@registered(
    "purge_null_keys",
    """
SELECT o_orderkey AS post_id, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""",
)
def purge_null_keys(spark, sf_dir):
    return tables.purge_null_keys(_with_null_keys(spark, sf_dir), "post_id")


@registered(
    "purge_null_keys_count",
    "SELECT count(*) FILTER (o_orderstatus = 'P') AS deleted FROM orders",
)
def purge_null_keys_count(spark, sf_dir):
    return tables.purged_count(_with_null_keys(spark, sf_dir), "post_id")


@registered(
    "drop_without_key",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey <> 0""",
)
def drop_without_key(spark, sf_dir):
    line = views.load(spark, sf_dir, "lineitem")
    return filters.drop_without_key(line, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@registered(
    "drop_blank_keywords",
    """
SELECT event_id, event_type AS keyword FROM events WHERE event_type NOT IN ('view', 'error')""",
)
def drop_blank_keywords(spark, sf_dir):
    spelled = (
        F.when(F.col("event_type") == "view", " \t ")
        .when(F.col("event_type") == "error", "")
        .otherwise(F.col("event_type"))
    )
    events = views.load(spark, sf_dir, "events").select("event_id", spelled.alias("keyword"))
    return filters.drop_blank(events, "keyword")


@registered(
    "parse_counts",
    f"""
WITH e AS (SELECT event_id, event_type, value, {EVENT_NUMBER_SQL} AS k FROM events)
SELECT event_id, CAST(CASE event_type WHEN 'click' THEN k * 1000 + 500
    WHEN 'signup' THEN k * 1000000 + 250000 WHEN 'view' THEN event_id
    WHEN 'purchase' THEN 0 END AS BIGINT) AS n
FROM e""",
)
def parse_counts(spark, sf_dir):
    k = views.event_number().cast("string")
    kind = F.col("event_type")
    spelled = (
        F.when(kind == "click", F.concat(k, F.lit(".5K")))
        .when(kind == "signup", F.concat(F.lit(" "), k, F.lit(".25m ")))
        .when(kind == "view", F.format_number("event_id", 0))
        .when(kind == "purchase", F.format_number("value", 2))
        .otherwise(F.concat(F.lit("like "), k))
    )
    spelled_events = views.load(spark, sf_dir, "events").select(
        "event_id", spelled.alias("shown")
    )
    return spelled_events.select(
        "event_id", numbers.parse_count(F.col("shown")).alias("n")
    )


@registered(
    "product_metrics",
    """
WITH p AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 1000 AS DOUBLE) / 100000.0::DOUBLE AS before,
         CAST(CAST(round(l_extendedprice * (1.0::DOUBLE - l_discount) * 100) AS BIGINT) * 1000
              AS DOUBLE) / 100000.0::DOUBLE AS price, l_tax, l_quantity
  FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate AS crawl_date,
       price, before AS price_before_discount,
       CASE WHEN before > 0 THEN CAST(round_even((before - price) / before * 100, 0) AS BIGINT) || '%'
            ELSE '0%' END AS discount,
       round_even(l_tax * l_quantity, 2) AS rating_star,
       CAST(CASE WHEN l_quantity > 10 THEN l_quantity ELSE 0 END AS BIGINT) AS rating_count
FROM p""",
)
def product_metrics(spark, sf_dir):
    def units(value):
        return F.round(value * 100).cast("bigint") * 1000

    after = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    ratings = F.when(F.col("l_quantity") > 10, F.array("l_quantity", "l_tax")).otherwise(
        F.array().cast("array<double>")
    )
    raw = views.load(spark, sf_dir, "lineitem").select(
        "*",
        numbers.from_price_units(units(F.col("l_extendedprice"))).alias("before"),
        numbers.from_price_units(units(after)).alias("price"),
        ratings.alias("ratings"),
    )
    return raw.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_shipdate").alias("crawl_date"),
        "price",
        F.col("before").alias("price_before_discount"),
        numbers.discount_text(F.col("before"), F.col("price")).alias("discount"),
        numbers.two_places(F.col("l_tax") * F.col("l_quantity")).alias("rating_star"),
        numbers.whole(F.get("ratings", F.lit(0))).alias("rating_count"),
    )


@registered(
    "clean_caption",
    r"""
WITH c AS (
  SELECT doc_id, trim(regexp_replace(text,
    '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+',
    ' ', 'g')) AS t FROM documents)
SELECT doc_id, substring(t, 1, 400) AS caption, CAST(length(t) AS BIGINT) AS n_clean,
       md5(t) AS fingerprint
FROM c""",
)
def clean_caption(spark, sf_dir):
    cleaned = views.load(spark, sf_dir, "documents").select(
        "doc_id", texts.clean_spaces(F.col("text")).alias("t")
    )
    return cleaned.select(
        "doc_id",
        texts.first_chars(F.col("t"), settings.CAPTION_CHARS).alias("caption"),
        F.length("t").cast("bigint").alias("n_clean"),
        F.md5("t").alias("fingerprint"),
    )


@registered(
    "time_render",
    """
WITH e AS (
  SELECT event_id, date_trunc('second', ts) AS s, ts,
         date_trunc('second', ts) + INTERVAL 7 HOUR AS v FROM events)
SELECT event_id, s AS created_at, strftime(v, '%Y-%m-%d %H:%M:%S') AS local_text,
       strftime(s, '%Y-%m-%d') AS day_text, strftime(v, '%Y-%m-%d') AS local_day,
       strftime(s, '%Y-%m-%dT%H:%M') AS session_id, CAST(s AS DATE) AS iso_day,
       ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR AS is_recent
FROM e""",
)
def time_render(spark, sf_dir):
    events = views.load(spark, sf_dir, "events")
    recent = times.since(events, "ts", "2024-01-31 00:00:00", 36)
    timed = events.select(
        "event_id", times.epoch_seconds(F.col("ts")).alias("epoch"), recent.alias("is_recent")
    )
    epoch = F.col("epoch")
    iso = F.concat(times.day_text(epoch), F.lit("T00:00:00Z"))
    return timed.select(
        "event_id",
        times.wall_clock(epoch).alias("created_at"),
        times.local_text(epoch, settings.LOCAL_ZONE).alias("local_text"),
        times.day_text(epoch).alias("day_text"),
        times.day_text(epoch, settings.LOCAL_ZONE).alias("local_day"),
        F.date_format(times.wall_clock(epoch), times.MINUTE).alias("session_id"),
        times.iso_day(iso).cast("date").alias("iso_day"),
        "is_recent",
    )


_TEMPLATES = ("{kw}", "of {kw}", "{kw} and", "le {kw}", "{kw} mit")
_KEYWORDS = ("the", "que", "und")


@registered(
    "expand_keywords",
    f"""
WITH v AS (
  SELECT k AS base_keyword, CAST(n AS BIGINT) AS variant_no, replace(t, '{{kw}}', k) AS phrase
  FROM (VALUES {", ".join(f"('{k}')" for k in _KEYWORDS)}) a(k),
       (VALUES {", ".join(f"({n}, '{t}')" for n, t in enumerate(_TEMPLATES))}) b(n, t)
  WHERE n < 4)
SELECT base_keyword, variant_no, phrase, count(*) AS n_documents
FROM v JOIN documents d ON contains(lower(d.text), v.phrase) GROUP BY ALL""",
)
def expand_keywords(spark, sf_dir):
    documents = views.load(spark, sf_dir, "documents").select("doc_id", "text")
    hits = keywords.tag_with_keywords(documents, "text", _KEYWORDS, _TEMPLATES, 4)
    return hits.groupBy("base_keyword", F.col("variant_no").cast("bigint"), "phrase").agg(
        F.count("*").alias("n_documents")
    )


@registered(
    "keyword_phrases",
    f"""
WITH t AS (
  SELECT CAST(n AS BIGINT) AS variant_no, t
  FROM (VALUES {", ".join(f"({n}, '{t}')" for n, t in enumerate(settings.PRODUCT_TEMPLATES))}) b(n, t)
  WHERE n < 7),
k AS (SELECT event_type AS keyword, count(*) AS n_events FROM events GROUP BY 1)
SELECT keyword, n_events, variant_no, replace(t, '{{kw}}', keyword) AS phrase FROM k, t""",
)
def keyword_phrases(spark, sf_dir):
    found = views.load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("keyword"))
    counted = found.agg(F.count("*").alias("n_events"))
    return keywords.expand_keywords(counted, "keyword", settings.PRODUCT_TEMPLATES, 7).withColumn(
        "variant_no", F.col("variant_no").cast("bigint")
    )


@registered(
    "split_tags",
    """
SELECT p_partkey, array_to_string(string_split(p_name, ' '), ', ') AS tags,
       CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_tags FROM part""",
)
def split_tags(spark, sf_dir):
    spaced = F.replace("p_name", F.lit(" "), F.lit(" , ,"))
    parts = views.load(spark, sf_dir, "part").select(
        "p_partkey", texts.split_list(spaced).alias("tags")
    )
    return parts.select(
        "p_partkey",
        F.array_join("tags", ", ").alias("tags"),
        F.size("tags").cast("bigint").alias("n_tags"),
    )


@registered(
    "surrogate_id",
    """
SELECT c_custkey, 'fb_user_' || CAST('0x' || substr(md5(c_name), 1, 15) AS BIGINT) % 1000000000 AS author_id
FROM customer""",
)
def surrogate_id(spark, sf_dir):
    number = texts.surrogate_number(F.col("c_name"), settings.SURROGATE_MODULUS)
    return views.load(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(settings.AUTHOR_ID_PREFIX), number.cast("string")).alias("author_id"),
    )
