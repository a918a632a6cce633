"""Response bodies to records: every alternative place and notation."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from snapmart.plans import posts, products, shorts, videos
from snapmart.registry import bodies as spelled
from snapmart.sources import responses


def bodies(spark, *documents, keyword="kw"):
    rows = [
        (keyword, seq, document if isinstance(document, str) else json.dumps(document))
        for seq, document in enumerate(documents)
    ]
    return spark.createDataFrame(rows, "keyword string, seq bigint, body string")


def edge(story):
    return {"rendering_strategy": {"view_model": {"click_model": {"story": story}}}}


def search(*stories):
    edges = [edge(s) for s in stories]
    return {"data": {"serpResponse": {"results": {"edges": edges}}}}


def target(feedback=None, profile=None):
    found = {}
    if feedback is not None:
        found["comet_ufi_summary_and_actions_renderer"] = {"feedback": feedback}
    if profile is not None:
        found["owning_profile"] = profile
    return {
        "story": {
            "story_ufi_container": {
                "story": {"feedback_context": {"feedback_target_with_context": found}}
            }
        }
    }


def story(id="1", text="hello", actors=None, feedback=None, profile=None, context=None, **more):
    content = {"comet_sections": {"message": {"story": {"message": {"text": text}}}}}
    if actors is not None:
        content["actors"] = actors
    sections = {"content": {"story": content}, "feedback": target(feedback, profile)}
    if context is not None:
        sections["context_layout"] = {"story": {"comet_sections": context}}
    sections.update(more.pop("sections", {}))
    return {"id": id, "comet_sections": sections, **more}


def flat(spark, *stories):
    return posts.flatten(bodies(spark, search(*stories))).orderBy("pos").collect()


AUTHORS = [
    ({"actors": [{"id": "1", "name": "A"}]}, ("1", "A")),
    ({"actors": [{"id": "1", "name": None}]}, ("1", None)),
    ({"actors": [{"name": "A"}], "profile": {"id": "2", "name": "B"}}, ("2", "B")),
    (
        {
            "actors": [{"name": "A"}],
            "context": {"actor_photo": {"story": {"actors": [{"id": "3", "name": "C"}]}}},
        },
        ("3", "C"),
    ),
    ({"actors": [{"name": "A"}], "profile": {"name": None}}, ("fb_user_", "A")),
    ({"actors": [{"name": "A"}], "profile": {"name": "B"}}, ("fb_user_", "B")),
    (
        {
            "profile": {"name": "B"},
            "context": {"actor_photo": {"story": {"actors": [{"name": "C"}]}}},
        },
        ("fb_user_", "C"),
    ),
    ({}, ("fb_user_", "Unknown")),
]


def test_author(spark):
    rows = flat(spark, *(story(id=f"s{n}", **given) for n, (given, _) in enumerate(AUTHORS)))
    assert len(rows) == len(AUTHORS)
    for row, (_, (author_id, name)) in zip(rows, AUTHORS, strict=True):
        assert row.owner == name
        assert row.author_id == author_id or (
            author_id == "fb_user_" and row.author_id.startswith("fb_user_")
        )


def test_reactions(spark):
    feedback = {
        "i18n_reaction_count": "1.2K",
        "top_reactions": {
            "edges": [
                {"reaction_count": 1000, "node": {"localized_name": "Like"}},
                {"i18n_reaction_count": "200", "node": {"reaction_type": "Love"}},
                {"reaction_count": 5, "node": {"localized_name": None}},
                {"reaction_count": 0, "node": {"localized_name": "Haha"}},
            ]
        },
    }
    (row,) = flat(spark, story(feedback=feedback))
    assert row.reactions == {"total": 1200, "Like": 1000, "Love": 200}
    assert row.problem is None


def test_a_later_reaction_of_the_same_name_wins(spark):
    edges = [{"reaction_count": n, "node": {"localized_name": "Like"}} for n in (1, 2)]
    edges.append({"reaction_count": 9, "node": {"localized_name": "total"}})
    feedback = {"i18n_reaction_count": "7", "top_reactions": {"edges": edges}}
    (row,) = flat(spark, story(feedback=feedback))
    assert row.reactions == {"Like": 2, "total": 9}


def test_no_feedback_means_no_reactions(spark):
    (row,) = flat(spark, story())
    assert row.reactions == {}
    assert (row.comment_count, row.share_count, row.view_count) == (0, 0, 0)


def test_unreadable_counts_are_marked_and_alone(spark):
    rows = flat(
        spark,
        story(id="1", feedback={"i18n_reaction_count": "LIKE"}),
        story(id="2", feedback={"share_count": {"count": "many"}}),
        story(id="3"),
    )
    assert [r.problem for r in rows] == ["unreadable count", "unreadable count", None]


def test_attachments_and_media_urls(spark):
    def attached(media, url=None):
        return {"styles": {"attachment": {"url": url, "media": media}}}

    attachments = [
        attached({"__typename": "Photo", "id": "p", "url": "u0"}, url="u1"),
        attached({"id": "q", "thumbnailImage": {"uri": "t2"}}),
        attached({"id": "r", "preferred_story_attachment_image": {"uri": "t3"}}),
        attached({}, url="dropped"),
        attached({"__typename": "Nothing"}),
        "stray",
        None,
        attached({"id": "s", "url": ""}),
    ]
    (row,) = flat(spark, story(attachments=attachments))
    assert [(a.type, a.id, a.url, a.thumbnail) for a in row.attachments] == [
        ("Photo", "p", "u1", None),
        (None, "q", None, "t2"),
        (None, "r", None, "t3"),
        (None, "s", "", None),
    ]
    records = posts.flatten(bodies(spark, search(story(attachments=attachments))))
    master = posts.to_master_rows(records, F.lit("2024-02-01 03:04:05").cast("timestamp")).first()
    assert master.media_urls == ["u1", "t2", "t3"]
    assert master.crawl_session_id == "2024-02-01T03:04"


def test_text_places_type_and_times(spark):
    seconds = {"timestamp": {"story": {"creation_time": 1700000000}}}
    rows = flat(
        spark,
        story(id="1", text="", message={"text": "second"}, __typename="Video"),
        story(id="2", sections=seconds),
        story(
            id="3",
            context={"metadata": [{}, {"story": {"creation_time": 1700000001}}]},
        ),
        story(id="4", sections={"timestamp": {"story": {"creation_time": "1700000000"}}}),
    )
    assert [r.text for r in rows] == ["second", "hello", "hello", "hello"]
    assert [r.type for r in rows] == ["Video", "Story", "Story", "Story"]
    assert [r.publish_time for r in rows] == [0, 1700000000, 1700000001, 0]


def test_records_without_id_or_content_vanish(spark):
    photo = [{"styles": {"attachment": {"media": {"id": "p"}}}}]
    rows = flat(
        spark,
        story(id=None),
        story(id=""),
        story(id="1", text=""),
        story(id="2", text="", attachments=photo),
        None,
        {},
    )
    assert [r.id for r in rows] == ["2"]


def test_result_places_and_bad_bodies(spark):
    second = {
        "data": {
            "serpResponse": {"results": {"edges": []}},
            "results": {"edges": ["stray", edge(story(id="9"))]},
        }
    }
    given = bodies(spark, second, "{broken", {"data": {}}, "for (;;);" + json.dumps(search(story())))
    rows = posts.flatten(given).orderBy("seq").collect()
    assert [(r.seq, r.pos, r.id) for r in rows] == [(0, 1, "9"), (3, 0, "1")]


def test_metrics_rows(spark):
    feedback = {
        "i18n_reaction_count": "1.2K",
        "top_reactions": {"edges": [{"reaction_count": 3, "node": {"localized_name": "Like"}}]},
    }
    records = posts.flatten(bodies(spark, search(story(feedback=feedback), story(id="2"))))
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    first, second = posts.to_metrics_rows(records, as_of).orderBy("post_id").collect()
    assert (first.post_id, first.likes, first.reaction_breakdown) == (
        "facebook_1",
        1200,
        {"Like": 3},
    )
    assert (second.likes, second.reaction_breakdown) == (0, {})


def test_routing_of_posts(spark):
    good = json.dumps(search(story()))
    rows = [
        ("https://x/api/graphql/", "for (;;);" + good),
        ("https://x/api/graphql/", good),
        ("https://x/other", good),
        ("https://x/api/graphql/", "{}"),
        ("https://x/api/graphql/", json.dumps({"data": {"serpResponse": None}, "pad": 1})),
        ("https://x/api/graphql/", "while(1);" + good),
        ("https://x/api/graphql/", None),
    ]
    routed = responses.route_posts(spark.createDataFrame(rows, "url string, body string"))
    assert [r.body for r in routed.collect()] == [good, good]


def test_quarantine(spark):
    rows = [(1, "{bad" + "x" * 2000), (2, '{"a":1}'), (3, "null"), (4, None)]
    dead = responses.undecodable(spark.createDataFrame(rows, "seq bigint, body string"))
    found = {r.seq: r.body for r in dead.collect()}
    assert set(found) == {1, 3, 4}
    assert len(found[1]) == 2004


def test_videos(spark):
    def item(id="v", title="t", published="2024-05-06T10:00:00Z", stats=None, **snippet):
        return {
            "id": id,
            "snippet": {"title": title, "publishedAt": published, **snippet},
            "statistics": stats or {},
        }

    document = {
        "items": [
            item(stats={"viewCount": "12", "likeCount": 3}, tags=["a", "b"], channelTitle="C"),
            item(id="w", stats={"viewCount": "many"}),
            item(id="x", channelTitle=" Yến Nồi Cơm Điện Official "),
            item(id="y", title=None),
            {"snippet": {"title": "no id"}},
        ]
    }
    rows = {r.video_id: r for r in videos.flatten(bodies(spark, document)).collect()}
    assert set(rows) == {"v", "w", "y"}
    v = rows["v"]
    assert (v.views, v.likes, v.comments, v.tags, v.published_at) == (12, 3, 0, "a, b", "2024-05-06")
    assert (rows["w"].views, rows["w"].channel_id, rows["w"].tags) == (None, "", "")
    assert (v.problem, rows["w"].problem) == (None, "unreadable count")
    assert rows["y"].problem is not None


def test_video_search_hits(spark):
    document = {
        "items": [
            {"id": {"videoId": "a"}, "snippet": {"channelTitle": "x"}},
            {"id": {"videoId": "b"}, "snippet": {"channelTitle": "YẾN NỒI CƠM ĐIỆN"}},
            {"id": {"videoId": "c"}, "snippet": {}},
            {"id": {}, "snippet": {}},
        ]
    }
    assert [r.video_id for r in videos.search_hits(bodies(spark, document)).collect()] == ["a", "c"]


def test_shorts(spark):
    document = {
        "data": [
            {
                "item": {
                    "id": "1",
                    "desc": "d" * 500,
                    "createTime": "1700000000",
                    "author": {"uniqueId": "u", "nickname": "n"},
                    "stats": {"diggCount": 1, "playCount": 2},
                }
            },
            {"video": {"id": "2"}, "stats": {}, "statsV2": {"playCount": "5"}, "desc": None},
            "stray",
            {"item": None},
            {"item": {"desc": "no id"}},
            {"id": "3", "createTime": "soon"},
        ]
    }
    rows = {r.id: r for r in shorts.flatten(bodies(spark, document)).collect()}
    assert set(rows) == {"1", "2", "3"}
    assert (rows["1"].likes, rows["1"].views, rows["1"].shares) == (1, 2, 0)
    assert rows["1"].create_time == "2023-11-15 05:13:20"
    assert len(rows["1"].caption) == 400
    assert (rows["2"].views, rows["2"].create_time, rows["2"].author_username) == (5, "", None)
    assert rows["2"].caption == ""
    assert rows["3"].create_time == ""
    assert rows["1"].category == "kw"


def test_products(spark):
    def item(itemid, **fields):
        return {"item_basic": {"itemid": itemid, **fields}}

    document = {
        "items": [
            item(
                1,
                price=599000000000,
                price_before_discount=799000000000,
                name=" a\t b ",
                item_rating={"rating_star": 4.8125, "rating_count": [320, 1]},
                sold=3,
                historical_sold=9,
                flash_sale=True,
                ctime=1700000000,
            ),
            item(2, price_min=100000, item_rating={"rating_count": []}, ctime=None),
            item(3),
            item(4, price="dear"),
            item(0),
            item(None),
            {"other": 1},
        ]
    }
    rows = {r.itemid: r for r in products.flatten(bodies(spark, document)).collect()}
    assert set(rows) == {1, 2, 3, 4}
    r = rows[1]
    assert (r.price, r.price_before_discount, r.discount) == (5990000.0, 7990000.0, "25%")
    assert (r.name, r.rating_star, r.rating_count) == ("a b", 4.81, 320)
    assert (r.sold_recent, r.sold_total, r.flash_sale, r.ctime) == (3, 9, True, "2023-11-14")
    assert (rows[2].price, rows[2].price_before_discount, rows[2].discount) == (1.0, 1.0, "0%")
    assert (rows[2].rating_count, rows[2].ctime) == (0, "")
    assert (rows[3].price, rows[3].discount, rows[3].ctime) == (0.0, "0%", "1970-01-01")
    assert rows[3].flash_sale is False
    assert rows[4].problem is not None
    assert all(rows[i].problem is None for i in (1, 2, 3))


def test_instants_are_utc(spark):
    records = posts.flatten(
        bodies(
            spark,
            search(story(sections={"timestamp": {"story": {"creation_time": 1700000000}}})),
        )
    )
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    row = posts.to_master_rows(records, as_of).select(F.unix_seconds("created_at")).first()
    assert row[0] == 1700000000


def test_counts_that_cannot_be_read_are_problems(spark):
    short = {"data": [
        {"id": "a", "stats": {"playCount": "12.5K"}},
        {"id": "b", "stats": {"diggCount": "1,234"}},
        {"id": "c", "stats": {"playCount": "7"}},
        {"id": "d", "stats": {"shareCount": None}},
    ]}
    rows = {r.id: r for r in shorts.flatten(bodies(spark, short)).collect()}
    assert [rows[i].problem for i in "abd"] == ["unreadable count"] * 3
    assert (rows["a"].views, rows["b"].likes, rows["c"].views, rows["c"].problem) == (None, None, 7, None)
    basic = [
        {"itemid": 1, "sold": "many"},
        {"itemid": 2, "historical_sold": "1.2k"},
        {"itemid": 3, "price": None},
        {"itemid": 4, "item_rating": {"rating_star": None}},
        {"itemid": 5, "sold": "3"},
    ]
    product = {"items": [{"item_basic": b} for b in basic]}
    rows = {r.itemid: r for r in products.flatten(bodies(spark, product)).collect()}
    assert [rows[i].problem for i in (1, 2)] == ["unreadable count"] * 2
    assert [rows[i].problem for i in (3, 4)] == ["unreadable price or rating"] * 2
    assert (rows[5].sold_recent, rows[5].sold_total, rows[5].problem) == (3, 0, None)


def test_events_of_one_row_group_are_dealt_out(spark, tmp_path):
    rows = spark.range(600).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "'{\"k\": 1}' AS props"
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    sizes = spelled.post_responses(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert sum(r["count"] for r in sizes) == 600 and max(r["count"] for r in sizes) <= 100
