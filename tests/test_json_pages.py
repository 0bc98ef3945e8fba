"""One literal page per rule of the embedded document."""

import json

import pytest
from pyspark.sql import functions as F

from pages import HEAD, detail, info, post, script, tile
from reelbook import extract_pages, extract_profiles, extract_videos, quarantine
from reelbook.schemas import SCRIPT_ID


def ids(row):
    return [video.url.rsplit("/", 1)[1] for video in row.videos or []]


FULL = detail(
    userInfo=info(
        nickname="Ann", signature="sig", bio="b", bioLink={"link": "l"}, avatarLarger="p",
        verified=True, stats={"followingCount": 1, "followerCount": 2, "heartCount": 3},
    ),
    posts=[
        post(
            "10", desc="d", createTime=1700000000, video={"cover": "c"},
            stats={"playCount": 1, "diggCount": 2, "commentCount": 3, "shareCount": 4},
        )
    ],
)


@pytest.mark.page(script(FULL))
def test_full_profile_and_video(row):
    profile = row.profile.asDict()
    assert str(profile.pop("scrape_timestamp")) == "2024-05-01 10:00:00"
    assert profile == {
        "username": "ann", "user_id": "1", "actual_name": "Ann", "following_count": 1,
        "follower_count": 2, "total_like_count": 3, "caption": "sig", "bio_link": "l", "bio": "b",
        "profile_pic_url": "p", "is_verified": True,
    }
    assert [video.asDict() for video in row.videos] == [
        {
            "url": "https://www.tiktok.com/@ann/video/10", "views": 1, "thumbnail": "c",
            "description": "d", "create_time": "2023-11-14T22:13:20", "like_count": 2,
            "comment_count": 3, "share_count": 4,
        }
    ]
    assert (row.fault, row.video_fault, row.lost_posts) == (None, None, 0)


@pytest.mark.page(script(detail(userInfo=info(), posts=[
    post("1", createTime="1_700_000_000"), post("2", createTime=" +1_7 "), post("3", createTime="1__7"), post("4"),
])))
def test_times_with_underscores(row):
    """Read as whole numbers; a doubled underscore is none, and ends the list."""
    assert [v.create_time for v in row.videos] == ["2023-11-14T22:13:20", "1970-01-01T00:00:17"]
    assert row.lost_posts == 2


def test_documents_too_large(spark, make_pages):
    """What no VARIANT holds is left out under its own reason, unless it is malformed as well."""
    head, rest = script(detail(userInfo=info(nickname="Ann"), posts=[post("10")])).split("{", 1)
    pages = make_pages({"p/a/1.html": head, "p/b/1.html": head, "p/c/1.html": head})
    n = F.when(F.col("path") == "p/c/1.html", 4_000_000).otherwise(24_000_000)
    bulk = F.concat(F.lit('{"bulk":['), F.repeat(F.lit("1,"), n), F.when(F.col("path") == "p/b/1.html", "x").otherwise("0"), F.lit("],"))
    pages = pages.withColumn("html", F.concat("html", bulk, F.lit(rest))).coalesce(1)
    found = extract_pages(pages, columns=["fault", "profile"]).collect()
    rows = {row.path[2]: (row.fault, row.profile and row.profile.actual_name) for row in found}
    assert rows == {"a": ("document_too_large", None), "b": ("malformed_json", None), "c": (None, "Ann")}


@pytest.mark.page(
    script(detail(userInfo=info(nickname=None, bioLink={}), posts=[post("1", desc=None)]))
)
def test_defaults_and_nulls(row):
    assert row.profile.actual_name is None
    assert row.profile.bio_link == "No link"
    assert row.profile.follower_count == 0
    assert row.profile.is_verified is False
    video = row.videos[0]
    assert (video.description, video.thumbnail, video.create_time) == (None, "N/A", "N/A")
    assert (video.views, video.like_count) == (0, 0)


@pytest.mark.parametrize(
    "html",
    [
        script(detail(userInfo=info()), ident=f"type=x id='{SCRIPT_ID}'"),
        script(detail(userInfo=info()), ident=f"id={SCRIPT_ID}"),
        script(detail(userInfo=info()), ident=f'ID = "{SCRIPT_ID}" data-x="a>b"'),
        script(detail(userInfo=info())).replace("script", "SCRIPT"),
        "<script>var a='<!--';</script>" + script(detail(userInfo=info())),
        "<style>a:after{content:'<script>'}</style>" + script(detail(userInfo=info())),
        f'<!-- <script id="{SCRIPT_ID}">{{</script> -->' + script(detail(userInfo=info())),
        "<!-- open " + script(detail(userInfo=info())),
        "<script>open" * 2 + "</script>" + script(detail(userInfo=info())),
        "<!--><b>x</b> -- ><!---> <p> -->" + script(detail(userInfo=info())),
        script(detail(userInfo=info(bio="<!-- <script> </style> --> <style>"))),
        script(detail(userInfo=info())) + script(detail(userInfo=info(uniqueId="two"))),
        f'<script data-id="{SCRIPT_ID}">{{</script>' + script(detail(userInfo=info())),
        f"<script>'id=\"{SCRIPT_ID}\"'</script>" + script(detail(userInfo=info())),
        script("　\n" + '{"__DEFAULT_SCOPE__":{"webapp.user-detail":{"userInfo":'
               '{"user":{"uniqueId":"old","uniqueId":"ann"}}}}}' + " "),
    ],
)
def test_script_is_found(row, html):
    assert row.profile_source == "json"
    assert row.profile.username == "ann"


@pytest.mark.parametrize(
    "html",
    [HEAD + tile() + html for html in [
        f'<script id="{SCRIPT_ID}"></script>',
        f'<script id="{SCRIPT_ID}"></script>' + script(detail(userInfo=info())),
        f'<script id="{SCRIPT_ID}">{{"a":1}}',
        f'<!-- <script id="{SCRIPT_ID}">{{</script> -->',
        f'<script id="{SCRIPT_ID}x">{{</script>',
        f'<script src=a id="{SCRIPT_ID}"/>',
        script({"other": 1}),
        script({"__DEFAULT_SCOPE__": {"other": 1}}),
        script({"__DEFAULT_SCOPE__": "text"}),
        script({"__DEFAULT_SCOPE__": ["other"]}),
        script({"ItemModule": {"1": post("1")}}),
        script([1, 2]),
        script('"text"'),
    ]],
)
def test_pages_without_document_use_markup(row, html):
    assert (row.fault, row.profile_source, row.video_source) == (None, "html", "html")
    assert row.profile.username == "ann"
    assert row.videos[0].views == 99


@pytest.mark.parametrize(
    "html, fault",
    [(HEAD + script(document), fault) for document, fault in [
        ("{", "malformed_json"),
        ("  ", "malformed_json"),
        ("{} x", "malformed_json"),
        ("{}, {}", "malformed_json"),
        ("{}] ", "malformed_json"),
        ("1, 1", "malformed_json"),
        ('{"a":NaN}', "malformed_json"),
        ("null", "document_kind"),
        ("5", "document_kind"),
        ('"__DEFAULT_SCOPE__"', "document_kind"),
        (["__DEFAULT_SCOPE__"], "document_kind"),
        ({"__DEFAULT_SCOPE__": None}, "document_kind"),
        ({"__DEFAULT_SCOPE__": "webapp.user-detail"}, "document_kind"),
        ({"__DEFAULT_SCOPE__": {"webapp.user-detail": None}}, "user_detail_kind"),
        ({"__DEFAULT_SCOPE__": {"webapp.user-detail": []}}, "user_detail_kind"),
        (detail(userInfo=None), "user_info_kind"),
        (detail(userInfo={"user": None}), "user_kind"),
        (detail(userInfo={"stats": 1}), "stats_kind"),
        (detail(userInfo=info(bioLink=None)), "bio_link_kind"),
        (detail(userInfo=info(uniqueId=None)), "null_username"),
        (detail(userInfo=info(stats={"followerCount": 1.5})), "profile_value_kind"),
        (detail(userInfo=info(nickname=["a"])), "profile_value_kind"),
    ]],
)
def test_faulty_pages_give_nothing(row, html, fault):
    assert (row.fault, row.profile, row.videos) == (fault, None, None)


def test_other_page_faults(make_pages, spark):
    pages = make_pages({"t.html": script(detail(userInfo=info())), "p/a/t.html": None})
    found = {row.path: row.fault for row in extract_pages(pages).collect()}
    assert found == {"t.html": "path_without_folder", "p/a/t.html": "invalid_utf8"}


@pytest.mark.page(HEAD + script(detail(posts=[post("1")])))
def test_missing_user_info_mixes_sources(row):
    assert (row.profile_source, row.video_source) == ("html", "json")
    assert row.videos[0].url == "https://www.tiktok.com/@N/A/video/1"


@pytest.mark.page(HEAD + script(detail(userInfo=info(uniqueId="N/A"), posts=[post("1")])))
def test_explicit_default_username_falls_back(row):
    assert (row.profile_source, row.profile.username) == ("html", "ann")


@pytest.mark.page(HEAD + script(detail(userInfo=info(uniqueId=""))))
def test_empty_username_does_not_fall_back(row):
    assert (row.profile_source, row.profile.username) == ("json", "")


A, B = [post("a")], [post("b")]


@pytest.mark.parametrize(
    "html, expected",
    [(script(document), expected) for document, expected in [
        (detail(userInfo=info(), posts=A, itemList=B), ["a"]),
        (detail(userInfo=info(), posts=[], itemList=B), ["b"]),
        (detail(userInfo=info(), posts=None, ItemList=B), ["b"]),
        # an empty itemList hides ItemList
        (detail(userInfo=info(), itemList=[], ItemList=A), []),
        (detail(userInfo=info(stats={"videoList": B}), itemList=[], ItemList=A), ["b"]),
        (detail(userInfo=info(stats={"videoList": B}), posts=0), ["b"]),
        (detail(root={"ItemModule": {"z": post("9"), "a": post("8")}}, userInfo=info()), ["9", "8"]),
        (detail(root={"ItemModule": {}}, userInfo=info()), []),
        # a truthy place of another kind ends the search
        (detail(userInfo=info(), posts={"x": 1}, itemList=B), []),
        (detail(userInfo=info(), posts="text", itemList=B), []),
        (detail(userInfo=info(), posts=3, itemList=B), []),
        (detail(userInfo=info(), posts={}, itemList=B), ["b"]),
        (detail(root={"ItemModule": [post("1")]}, userInfo=info()), []),
    ]],
)
def test_source_chain(row, html, expected):
    assert ids(row) == expected


@pytest.mark.parametrize(
    "html, expected, lost",
    [(script(detail(userInfo=info(), posts=posts)), ids, lost) for posts, ids, lost in [
        ([post("1"), post("2", createTime=None), post("3")], ["1"], 2),
        ([post("1"), None, post("3")], ["1"], 2),
        ([post("1"), "text"], ["1"], 1),
        ([post("1"), post("2", stats=None)], ["1"], 1),
        ([post("1"), post("2", video=[])], ["1"], 1),
        ([post("1"), post("2", createTime="soon")], ["1"], 1),
        ([post("1"), post("2", createTime="1.5")], ["1"], 1),
        ([post("1"), post("2", createTime=1700000000000)], ["1"], 1),
        # a post without an id is skipped before anything else is looked at
        ([post(None, stats=None), post("", video=None), post(0), post(False), post("2")], ["2"], 0),
        ([{"desc": "x"}, post("0"), post(5)], ["0", "5"], 0),
    ]],
)
def test_prefix(row, html, expected, lost):
    assert (ids(row), row.lost_posts) == (expected, lost)
    assert row.video_fault == ("unreadable_post" if lost else None)


@pytest.mark.parametrize(
    "html, iso",
    [(script(detail(userInfo=info(), posts=[post("1", createTime=t)])), iso) for t, iso in [
        (1700000000, "2023-11-14T22:13:20"),
        ("1700000000", "2023-11-14T22:13:20"),
        (1700000000.9, "2023-11-14T22:13:20"),
        (True, "1970-01-01T00:00:01"),
        (-1, "1969-12-31T23:59:59"),
        ("N/A", "N/A"),
    ]],
)
def test_create_time(row, html, iso):
    assert row.videos[0].create_time == iso


@pytest.mark.page(tile() + script(detail(userInfo=info(), posts=[None, post("2")])))
def test_unreadable_first_post_falls_back_to_markup(row):
    assert (row.video_source, row.videos[0].views, row.lost_posts) == ("html", 99, 2)


@pytest.mark.page(
    script(detail(userInfo=info(), posts=[post("1"), post("2", stats={"playCount": "x"})]))
)
def test_unloadable_video_drops_the_videos_of_the_page(row):
    assert row.profile.username == "ann"
    assert (row.videos, row.video_fault) == (None, "video_value_kind")


@pytest.mark.page(script(detail(userInfo=info(), posts=[post("1"), post("1")])))
def test_repeated_ids_are_kept_before_the_merge(row):
    assert ids(row) == ["1", "1"]


@pytest.mark.page("<!-- x " * 20000 + "<script>" * 20000 + script(detail(userInfo=info())))
def test_many_unclosed_regions(row):
    """The scripts before it take it in; finding that out is linear in the page."""
    assert (row.fault, row.profile_source) == (None, "html")


@pytest.mark.page(script(detail(userInfo=info(bio="<!-- </style> -->"))))
def test_body_is_whole(row):
    assert row.profile.bio == "<!-- </style> -->"


def test_profiles_and_quarantine_cover_all_pages(make_pages):
    pages = make_pages([script("{"), script(detail(userInfo=info())), HEAD, "", script("null")])
    left_out = quarantine(pages).collect()
    assert extract_profiles(pages).count() + sum(q.scope == "page" for q in left_out) == 5
    assert sorted(q.reason for q in left_out) == ["document_kind", "malformed_json"]


def test_filters_of_the_caller(make_pages):
    """Filters on results plan quickly and parse each page once."""
    pages = make_pages([script(detail(userInfo=info(), posts=[post("1")])), script("{")])
    done = extract_pages(pages)
    assert done.filter("fault IS NOT NULL").count() == 1
    assert done.filter("size(videos) = 1").count() == 1
    good = extract_profiles(pages).filter("follower_count = 0")
    assert good.count() == 1
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("ArrowEvalPython") == 1
    assert extract_videos(pages).filter("views = 0").count() == 1


def body_script(body):
    return f'<script id="__UNIVERSAL_DATA_FOR_REHYDRATION__">{body}</script>'


def own_length():
    """A document followed by ``,N]``, where N is the length of the whole text."""
    document = json.dumps(detail(userInfo=info(), posts=[post("1")]))
    for n in range(len(document), len(document) + 20):
        if len(f"{document},{n}]") == n:
            return body_script(f"{document},{n}]")


@pytest.mark.page(own_length())
def test_trailing_text_is_never_taken_for_the_end(row):
    assert (row.fault, row.profile) == ("malformed_json", None)


def repeated_keys():
    document = detail(userInfo=info(), posts=None)
    posts = [json.dumps(post(key)) for key in "123"]
    body = json.dumps(document)[:-1]
    stale = f',"ItemModule":{{"9":{posts[2]}}}'
    last = f',"ItemModule":{{"b":{posts[2]},"a":{posts[0]},"b":{posts[1]}}}}}'
    return body_script(body + stale + last)


@pytest.mark.page(repeated_keys())
def test_last_value_of_a_repeated_key_at_its_first_place(row):
    assert [video.url[-1] for video in row.videos] == ["2", "1"]


@pytest.mark.parametrize(
    "html, count",
    [
        (body_script(json.dumps(detail(userInfo=info(stats={"followerCount": 7}))).replace(": 7", f": {text}")), count)
        for text, count in [("1e10", 10**10), ("1e3", 1000), ("12345678901.0", 12345678901), ("1.5e1", 15),
                            ("1.5", None), ("1e19", None), ("15e-1", None)]
    ],
)
def test_whole_numbers_in_any_spelling(row, html, count):
    if count is None:
        assert row.fault == "profile_value_kind"
    else:
        assert row.profile.follower_count == count
