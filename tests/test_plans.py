"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as contract
from snapmart import registry
from snapmart.registry import views


def plan_of(spark, name):
    frame = contract.queries()[name](spark, SF)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["trending_posts", "trending_videos", "trending_history", "trending_products"],
)
def test_ranked_lists_use_a_distributed_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


@pytest.mark.parametrize(
    "name", ["latest_snapshot", "dedup_first", "cap_per_keyword", "trending_posts"]
)
def test_ranked_windows_are_trimmed_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan


@pytest.mark.parametrize("name", ["cap_per_keyword", "cap_per_keyword_large"])
def test_caps_of_any_size_are_trimmed_before_each_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "_salt" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    # Before and after each of the two shuffles.
    assert plan.count("WindowGroupLimit") == 4


def test_history_of_older_days_is_not_opened(spark):
    plan = plan_of(spark, "trending_written_history")
    assert "PartitionFilters: [isnotnull(crawl_day" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "trending_posts")
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan
    assert "l_discount" not in plan
    history = plan_of(spark, "trending_history")
    assert "GreaterThanOrEqual(ts" in history


def test_small_keys_limit_the_snapshots_that_are_ranked(spark):
    assert "LeftSemi" in plan_of(spark, "trending_posts")


def test_global_latest_is_no_join(spark):
    plan = plan_of(spark, "attach_global_latest")
    assert "Join" not in plan
    assert "Subquery" in plan


def test_merge_joins_one_row_per_key(spark):
    plan = plan_of(spark, "merge_posts")
    assert plan.count("FullOuter") == 1
    assert "partial_min_by" in plan


OWN = set(registry.QUERIES)
STREAMED = {name for name in OWN if name.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(OWN - STREAMED))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan


def test_the_body_is_decoded_once_per_response(spark):
    from snapmart.plans import posts

    captured = views.load(spark, SF, "pages").selectExpr("url AS keyword", "html AS body")
    flat = posts.flatten(captured)
    plan = flat._jdf.queryExecution().executedPlan().toString()
    decoding = [line for line in plan.split("\n") if "parseJson" in line]
    assert len(decoding) == 1


def test_attachments_are_typed_once(spark):
    plan = plan_of(spark, "flatten_posts")
    typing = [line for line in plan.split("\n") if "preferred_story_attachment_image" in line]
    assert len(typing) == 1 and "Generate explode(array(" in typing[0]
