"""Pages to profiles and videos: the JSON document first, the markup where that fails.

:func:`extract_pages` gives one row per page and never shuffles. Page rows are
turned into record rows by exploding an array; a filter in its place would be
pushed down and run the JSON parse or the markup UDF a second time.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelbook.functions import text as tx
from reelbook.functions import variants as vr
from reelbook.operators import dom, jsondoc
from reelbook.schemas import (
    PROFILE_COLUMNS,
    PROFILE_DEFAULTS,
    PROFILE_KEY,
    VIDEO_COLUMNS,
    VIDEO_URL_BASE,
)

PAGE_KEYS = ("path", "time_created")
_PROFILE_FIELDS = [name for name in PROFILE_COLUMNS if name != "scrape_timestamp"]


@functools.cache
def over(build: Callable[..., Column], *names: str, **options) -> Column:
    """``build`` over columns of these names, built once: a stream plans every batch,
    and building the large expressions takes longer than planning them."""
    return build(*[F.col(name) for name in names], **options)


def read_document(pages: DataFrame) -> DataFrame:
    """Add the parsed document of each page and ``fault``, why a page cannot be used.

    Further columns: ``gate`` (the document holds a user detail), ``detail``,
    ``user``, ``stats`` and ``link`` (VARIANT parts, see :mod:`jsondoc`).
    """
    return (
        pages.withColumns(
            {
                "path_username": tx.path_username(F.col("path")),
                "script": over(jsondoc.script_body, "html"),
            }
        )
        .withColumn("body", over(tx.strip, "script"))
        .withColumn("doc", over(jsondoc.parse, "body"))
        .withColumn("whole", over(jsondoc.is_whole, "doc", "body"))
        .withColumn("gate", F.when(F.col("whole"), over(jsondoc.gate, "doc")))
        .withColumn("detail", F.when(F.col("gate"), over(jsondoc.detail_parts, "doc")))
        .withColumn("info", over(jsondoc.info_parts, "detail.userInfo"))
        .withColumns(
            {
                "user": over(jsondoc.user_parts, "info.user"),
                "stats": over(jsondoc.stats_parts, "info.stats"),
            }
        )
        .withColumns(
            {"link": over(jsondoc.link_of, "user.bioLink"), "fault": over(_document_fault)}
        )
    )


def _document_fault() -> Column:
    c = F.col
    return (
        F.when(c("html").isNull(), "invalid_utf8")
        .when(c("path_username").isNull(), "path_without_folder")
        .when(jsondoc.is_too_large(c("doc"), c("body")), "document_too_large")
        .when(c("script").isNotNull() & ~c("whole"), "malformed_json")
        .when(c("script").isNotNull() & c("gate").isNull(), "document_kind")
        .when(c("gate") & c("detail").isNull(), "user_detail_kind")
        .when(c("detail.userInfo").isNotNull() & c("info").isNull(), "user_info_kind")
        .when(c("info.user").isNotNull() & c("user").isNull(), "user_kind")
        .when(c("info.stats").isNotNull() & c("stats").isNull(), "stats_kind")
        .when(vr.is_wrong_object(c("user.bioLink")), "bio_link_kind")
    )


def from_json(pages: DataFrame, url_base: str = VIDEO_URL_BASE) -> DataFrame:
    """:func:`read_document` plus ``json_profile``, ``json_videos`` and ``lost_posts``.

    ``json_profile`` is NULL where the page has no document to read it from and
    holds only defaults where the document has no user info. ``lost_posts`` are
    the posts from the first unreadable one on.
    """
    parts = ("user", "stats", "link")
    places = ("detail.posts", "listed_posts", "items", "listed_items")
    places += ("stats.videoList", "listed_videos")
    usable = F.col("fault").isNull() & F.col("gate")
    return (
        read_document(pages)
        .withColumns(
            {
                "json_profile": F.when(usable, over(jsondoc.profile, *parts)),
                "json_loads": F.when(usable, over(jsondoc.profile_loads, *parts)),
                "listed_posts": over(jsondoc.as_list, "detail.posts"),
                "items": over(jsondoc.items_place, "doc", "detail.itemList"),
                "listed_videos": over(jsondoc.as_list, "stats.videoList"),
            }
        )
        .withColumn("listed_items", over(jsondoc.as_list, "items"))
        .withColumn("posts", F.when(usable, over(jsondoc.posts, "doc", "body", *places)))
        .withColumn("given", over(jsondoc.readings, "posts"))
        .withColumn("readable", over(jsondoc.readable_prefix, "given"))
        .withColumns(
            {
                "lost_posts": F.coalesce(F.size("posts") - F.size("readable"), F.lit(0)),
                # the number of json_videos, for those who need no more of them
                "json_count": F.coalesce(F.size(F.filter("readable", lambda r: r["has_id"])), F.lit(0)),
                "json_videos": over(
                    jsondoc.videos, "readable", "json_profile.username", url_base=url_base
                ),
            }
        )
    )


def extract_pages(
    pages: DataFrame, url_base: str = VIDEO_URL_BASE, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per page of ``pages(path, html, time_created)``.

    Columns: ``path``, ``time_created``, ``path_username``, ``fault`` (why the page
    gives nothing, else NULL), ``profile_source`` and ``video_source`` (``json`` or
    ``html``), ``profile``, ``videos``, ``video_fault`` (why videos are left out),
    ``json_videos`` (their number) and ``lost_posts``.

    The markup is parsed only for pages that need it: other pages hand the UDF a
    NULL, in the same pass over the data. With ``columns`` only these (and the page
    keys) are computed; leaving columns out afterwards does not save their work.
    """
    rows = _extract(pages, url_base=url_base)
    if columns is not None:
        rows = rows.select(*PAGE_KEYS, *columns)
    return sealed(rows, *PAGE_KEYS)


def sealed(rows: DataFrame, *keys: str) -> DataFrame:
    """The same rows behind a generator, which filters of the caller do not pass.

    A filter on a computed column would be rewritten in terms of the page text,
    repeating every step in between. Filters on ``keys`` still reach the scan.
    """
    others = [name for name in rows.columns if name not in keys]
    packed = rows.select(*keys, F.explode(F.array(F.struct(*others))).alias("sealed"))
    return packed.select(*keys, "sealed.*")


def _extract(
    pages: DataFrame, videos: bool = True, url_base: str = VIDEO_URL_BASE
) -> DataFrame:
    """:func:`extract_pages` with prunable columns; ``videos=False`` leaves the videos
    out, and with them the parsing of pages that lack only videos."""
    c = F.col
    no_json_profile = c("json_profile").isNull() | F.coalesce(
        c(f"json_profile.{PROFILE_KEY}") == PROFILE_DEFAULTS[PROFILE_KEY], F.lit(False)
    )
    no_json_videos = c("json_count") == 0
    need = c("ask_profile") | c("ask_videos")
    good = c("fault").isNull()
    keep_videos = good & ~F.coalesce(c("video_fault") == "video_value_kind", F.lit(False))
    source = lambda asked: F.when(good, F.when(c(asked), "html").otherwise("json"))
    return (
        from_json(pages, url_base)
        .withColumns(
            {
                "ask_profile": good & no_json_profile,
                "ask_videos": good & no_json_videos & F.lit(videos),
            }
        )
        .withColumn("page", dom.creator_nodes(F.when(need, c("html"))))
        .withColumn("marked", over(dom.marked_nodes, "page"))
        .withColumns(
            {
                "steps": F.when(c("ask_profile"), over(dom.profile_steps, "page", "marked")),
                "videos": F.when(c("ask_videos"), over(dom.videos, "page", "marked")).otherwise(
                    c("json_videos")
                ),
            }
        )
        .withColumns(
            {
                "profile": F.when(c("ask_profile"), over(dom.profile, "steps")).otherwise(
                    c("json_profile")
                ),
                "loads": F.when(c("ask_profile"), over(dom.profile_loads, "steps")).otherwise(
                    c("json_loads")
                ),
            }
        )
        .withColumn(
            "fault",
            F.when(c("fault").isNotNull(), c("fault"))
            .when(need & c("page").isNull(), "unreadable_markup")
            .when(c(f"profile.{PROFILE_KEY}").isNull(), "null_username")
            .when(~c("loads"), "profile_value_kind"),
        )
        .withColumn("video_fault", F.when(good, over(_video_fault)))
        .select(
            *PAGE_KEYS,
            "path_username",
            "fault",
            F.when(good, over(_profile_record)).alias("profile"),
            source("ask_profile").alias("profile_source"),
            F.when(keep_videos & F.lit(videos), over(_video_records, "videos")).alias("videos"),
            source("ask_videos").alias("video_source"),
            "video_fault",
            c("json_count").alias("json_videos"),
            F.when(good, c("lost_posts")).otherwise(0).alias("lost_posts"),
        )
    )


def _video_fault() -> Column:
    unloadable = F.exists("videos", lambda video: ~video["fits"])
    return F.when(unloadable, "video_value_kind").when(
        F.col("lost_posts") > 0, "unreadable_post"
    )


def _profile_record() -> Column:
    return F.struct(
        *[F.col(f"profile.{name}").alias(name) for name in _PROFILE_FIELDS],
        F.col("time_created").cast("timestamp").alias("scrape_timestamp"),
    )


def _video_records(videos: Column) -> Column:
    record = lambda video: F.struct(*[video[name].alias(name) for name in VIDEO_COLUMNS])
    return F.transform(videos, record)


def one_or_none(condition: Column, value: Column) -> Column:
    """Array of ``value`` where the condition holds, else NULL; explode it to select rows."""
    return F.when(condition, F.array(value))


def any_of(column: str) -> Column:
    """An array column to explode. As a plain column it would get a filter on its
    size, which is pushed down like any other."""
    return F.when(F.size(column) > 0, F.col(column))


def profile_rows(extracted: DataFrame, *more: str) -> DataFrame:
    """Profile records of :func:`extract_pages`, with further page columns if wanted."""
    rows = extracted.select(
        *more,
        F.explode(one_or_none(F.col("profile").isNotNull(), F.col("profile"))).alias("p"),
    )
    return rows.select(*more, "p.*")


def video_rows(extracted: DataFrame, *more: str, position: bool = False) -> DataFrame:
    """Video records of :func:`extract_pages`; ``position`` adds the place in the page."""
    rows = extracted.select(*more, F.posexplode(any_of("videos")).alias("position", "v"))
    return rows.select(*more, *(["position"] if position else []), "v.*")


def extract_profiles(pages: DataFrame) -> DataFrame:
    """One profile row per usable page."""
    return profile_rows(_extract(pages, videos=False))


def extract_videos(pages: DataFrame, url_base: str = VIDEO_URL_BASE) -> DataFrame:
    """All video rows of all usable pages, repeated URLs included."""
    return video_rows(_extract(pages, url_base=url_base))


def json_profiles(pages: DataFrame) -> DataFrame:
    """Profiles as the JSON document gives them, before any fallback."""
    record = F.struct(F.col("detail.userInfo").isNull().alias("defaulted"), "json_profile.*")
    rows = from_json(pages).select(
        "path", F.explode(one_or_none(F.col("json_profile").isNotNull(), record)).alias("p")
    )
    return rows.select("path", "p.*")


def json_videos(pages: DataFrame, url_base: str = VIDEO_URL_BASE) -> DataFrame:
    """Videos as the JSON document gives them, before any fallback."""
    rows = from_json(pages, url_base).select("path", F.posexplode(any_of("json_videos")))
    return rows.select("path", F.col("pos").alias("position"), "col.*").drop("fits")


def _marked(pages: DataFrame) -> DataFrame:
    return pages.withColumn("page", dom.creator_nodes(F.col("html"))).withColumn(
        "marked", over(dom.marked_nodes, "page")
    )


def html_profiles(pages: DataFrame) -> DataFrame:
    """Profiles as the markup gives them, for every page."""
    steps = _marked(pages).withColumn("steps", over(dom.profile_steps, "page", "marked"))
    profile = steps.withColumn("p", over(dom.profile, "steps"))
    rows = profile.select("path", F.col("steps.failed").alias("failed_step"), "p.*")
    return sealed(rows, "path")


def html_videos(pages: DataFrame) -> DataFrame:
    """Videos as the markup gives them, for every page."""
    videos = _marked(pages).withColumn("videos", over(dom.videos, "page", "marked"))
    rows = videos.select("path", F.posexplode(any_of("videos")))
    return rows.select("path", F.col("pos").alias("position"), "col.*").drop("fits")
