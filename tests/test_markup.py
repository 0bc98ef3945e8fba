"""Nodes, selectors and records from markup."""

import pytest
from pyspark.sql import functions as F

from pages import HEAD, tile
from reelbook.operators import dom


@pytest.fixture
def nodes(spark):
    def run(html, **limits):
        frame = spark.createDataFrame([(html,)], "html string")
        page = frame.select(dom.page_nodes(F.col("html"), **limits).alias("page"))
        row = page.select(
            "page",
            F.transform("page.nodes", lambda n: dom.node_text(F.col("page"), n)).alias("texts"),
        ).first()
        return [
            (n.tag, n.i, n.last, text, n.attrs) for n, text in zip(row.page.nodes, row.texts)
        ]

    return run


def texts(rows):
    return [(tag, text) for tag, _, _, text, _ in rows]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a<p>b", [("p", "ab"), ("p", "b")]),
        ("<p><b>a</p>b", [("p", "a"), ("b", "a")]),
        ("<p>a</b>c</p>", [("p", "ac")]),
        ("<p>a<br>b<img>c</p>", [("p", "abc"), ("br", ""), ("img", "")]),
        ("<div/>x<p>y</p>", [("div", ""), ("p", "y")]),
        ("<p>a<!-- <b>x</b> -->b</p>", [("p", "ab")]),
        ("<p>a<script>'<b>'</script>b<style>c</style></p>", [("p", "ab"), ("script", ""), ("style", "")]),
        ("<p>&amp;&lt;&eacute;&#65;&#x42;&#150;&nope;</p>", [("p", "&<éAB–&nope")]),
        ("<p>a<template><b>x</b></template>b</p>", [("p", "ab"), ("template", ""), ("b", "")]),
        ("<p>a <b>b</b>   <i>c</i> </p>", [("p", "a b c"), ("b", "b"), ("i", "c")]),
        ("<P>ü<B>é　</B>x</P>", [("p", "üé　x"), ("b", "é")]),
        ("", []),
    ],
)
def test_tree(nodes, html, expected):
    assert texts(nodes(html)) == expected


def test_descendants_and_attributes(nodes):
    rows = nodes('<div a="1" a="2" b><p><i>x</i></p></div><p c="&quot;">')
    assert [(tag, i, last) for tag, i, last, _, _ in rows] == [
        ("div", 0, 2), ("p", 1, 2), ("i", 2, 2), ("p", 3, 3),
    ]
    assert [attrs for *_, attrs in rows] == [{"a": "2", "b": ""}, {}, {}, {"c": '"'}]


def test_limits(nodes):
    rows = nodes('<div id="x" class="y"><a href="z">t</a></div>', tags=["a"], attrs=["href"])
    assert rows == [("a", 0, 0, "t", {"href": "z"})]


def test_null_page(spark):
    frame = spark.createDataFrame([(None,)], "html string")
    assert frame.select(dom.page_nodes(F.col("html"))).first()[0] is None


ANN = {
    "username": "ann", "user_id": "N/A", "actual_name": "Ann", "following_count": 1,
    "follower_count": 1234, "total_like_count": 1152, "caption": "hi",
    "bio_link": "https://x.example", "bio": "hi", "profile_pic_url": "p.jpg",
    "is_verified": True,
}


@pytest.mark.page(HEAD)
def test_profile(row):
    profile = row.profile.asDict()
    profile.pop("scrape_timestamp")
    assert profile == ANN
    assert row.videos == []


@pytest.mark.page("<p>nothing")
def test_nothing_found(row):
    assert row.profile.username == "N/A"
    assert row.profile.actual_name == "Unknown"
    assert row.profile.is_verified is False


@pytest.mark.parametrize(
    "html, changed",
    [(HEAD.replace(old, new), changed) for old, new, changed in [
        (">1</strong>", ">x</strong>", {"following_count": 0, "follower_count": 0, "total_like_count": 0,
                                        "bio": "N/A", "caption": "N/A", "bio_link": "No link",
                                        "profile_pic_url": "N/A", "is_verified": False}),
        ("115.2M", "many", {"total_like_count": 0, "bio": "N/A", "caption": "N/A",
                            "bio_link": "No link", "profile_pic_url": "N/A", "is_verified": False}),
        (' href="https://x.example"', "", {"bio_link": "No link", "profile_pic_url": "N/A",
                                           "is_verified": False}),
        (' src="p.jpg"', "", {"profile_pic_url": "N/A", "is_verified": False}),
    ]],
)
def test_freeze(row, html, changed):
    profile = row.profile.asDict()
    profile.pop("scrape_timestamp")
    assert profile == {**ANN, **changed}


LARGE = HEAD.replace("1,234", "9" * 20)


@pytest.mark.parametrize(
    "html, fault",
    # a count after the step that fails is never read
    [(LARGE, "profile_value_kind"), (LARGE.replace(">1<", ">x<"), None)],
)
def test_count_too_large_is_not_loaded(row, html, fault):
    assert row.fault == fault


STATS = (
    '<div class="a tiktok-9-stats"><strong data-e2e="like-count">1K</strong>'
    '<strong data-e2e="comment-count">2</strong><strong data-e2e="share-count">3</strong></div>'
)


@pytest.mark.page(
    tile(inner='<div class="tiktok-1\n-desc"> some <b>text</b> </div>' + STATS)
)
def test_video(row):
    assert [video.asDict() for video in row.videos] == [
        {
            "url": "/@ann/video/1", "views": 99, "thumbnail": "c.jpg", "description": "some text",
            "create_time": "N/A", "like_count": 1, "comment_count": 2, "share_count": 3,
        }
    ]


@pytest.mark.parametrize(
    "html",
    [tile(url="/1") + bad + tile(url="/2") for bad in [
        tile(url=None),
        tile(url=""),
        tile(url="N/A"),
        tile(views="none"),
        tile(image="<img>"),
        tile().replace(' href="/@ann/video/1"', ""),
        tile(inner=STATS.replace("1K", "K")),
    ]],
)
def test_bad_container_is_left_out(row, html):
    assert [video.url for video in row.videos] == ["/1", "/2"]


@pytest.mark.page('<div data-e2e="user-post-item"><a href="/v">x</a></div>')
def test_minimal_container(row):
    video = row.videos[0]
    assert (video.views, video.thumbnail, video.description) == (0, "N/A", "N/A")
    assert (video.like_count, video.comment_count, video.share_count) == (0, 0, 0)


@pytest.mark.page(tile(inner='<strong data-e2e="like-count">5</strong>'))
def test_counts_outside_the_stats_block_do_not_count(row):
    assert row.videos[0].like_count == 0


FEED = '<div class="x tiktok-0-DivVideoFeed">{}{}</div>'.format(
    *[tile(url).replace("user-post-item", "y") for url in ("/1", "/2")]
)


@pytest.mark.parametrize(
    "html, urls",
    [
        (FEED, ["/1"]),
        # not used when there is a post container anywhere
        (FEED + tile("/3"), ["/3"]),
        # containers inside containers
        (
            f'<div data-e2e="user-post-item">{tile("/in")}<a href="/out"></a></div>',
            ["/in", "/in"],
        ),
    ],
)
def test_containers(row, html, urls):
    assert [video.url for video in row.videos] == urls


@pytest.mark.page(HEAD + tile(views="9" * 20))
def test_video_count_too_large(row):
    assert (row.profile.username, row.videos, row.video_fault) == ("ann", None, "video_value_kind")


def test_each_part_of_a_profile_is_searched_for_once(spark):
    """A node used in several places, none of them always needed, is otherwise looked for in each."""
    frame = spark.createDataFrame([(HEAD,)], "html string").select(dom.creator_nodes(F.col("html")).alias("page"))
    marked = frame.withColumn("marked", dom.marked_nodes(F.col("page"))).select("marked", "page")
    steps = marked.select(F.when(F.rand() >= 0, dom.profile_steps(F.col("page"), F.col("marked"))).alias("steps"))
    whole = steps._jdf.queryExecution().analyzed().expressions().head().sql()  # not cut, as a plan's text is
    assert whole.count("filter(") == 7
    assert steps.first().steps.username
