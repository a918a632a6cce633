"""Search phrases made from base keywords, and tagging text with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def phrases(keyword: Column, templates: Sequence[str], count: int | None = None) -> Column:
    """Array of the first ``count`` phrases of a keyword, in template order."""
    chosen = F.array(*(F.lit(t) for t in templates))
    filled = F.transform(chosen, lambda t: F.replace(t, F.lit("{kw}"), keyword))
    return filled if count is None else F.slice(filled, 1, count)


def expand_keywords(
    keywords: DataFrame, column: str, templates: Sequence[str], count: int | None = None
) -> DataFrame:
    """One row per keyword and phrase, with the phrase's position."""
    return keywords.select(
        *keywords.columns,
        F.posexplode(phrases(F.col(column), templates, count)).alias("variant_no", "phrase"),
    )


def tag_with_keywords(
    texts: DataFrame,
    text: str,
    keywords: Sequence[str],
    templates: Sequence[str],
    count: int | None = None,
) -> DataFrame:
    """One row per text and phrase it contains (ignoring case).

    Keywords are run parameters, so they travel as literals: each text is read
    once where it lies, nothing is joined and only hits are produced.
    """
    lowered = texts.withColumn("_lowered", F.lower(text))
    hits = []
    for keyword in keywords:
        for number, template in enumerate(list(templates)[:count]):
            phrase = F.lit(template.replace("{kw}", keyword))
            hit = F.struct(
                F.lit(keyword).alias("base_keyword"),
                F.lit(number).alias("variant_no"),
                phrase.alias("phrase"),
            )
            hits.append(F.when(F.contains(F.col("_lowered"), F.lower(phrase)), hit))
    found = F.explode(F.array_compact(F.array(*hits))).alias("_hit")
    return lowered.select(*texts.columns, found).select(
        *texts.columns, "_hit.base_keyword", "_hit.variant_no", "_hit.phrase"
    )
