"""Pages and records that are left out, with the reason, and counts per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reelbook.operators.extract import extract_pages
from reelbook.schemas import PROFILE_KEY


def quarantine_rows(extracted: DataFrame) -> DataFrame:
    """``path, time_created, scope, reason, lost`` of :func:`extract.extract_pages`.

    Scope ``page``: the page gave no row at all. Scope ``videos``: its profile is
    kept, but all its videos (``video_value_kind``) or the posts from the first
    unreadable one on (``unreadable_post``, ``lost`` of them) are not.
    """
    entry = lambda scope, reason: F.struct(
        F.lit(scope).alias("scope"), F.col(reason).alias("reason")
    )
    entries = F.when(F.col("fault").isNotNull(), F.array(entry("page", "fault"))).when(
        F.col("video_fault").isNotNull(), F.array(entry("videos", "video_fault"))
    )
    rows = extracted.select("path", "time_created", "lost_posts", F.explode(entries).alias("q"))
    return rows.select(
        "path", "time_created", "q.scope", "q.reason", F.col("lost_posts").alias("lost")
    )


def quarantine(pages: DataFrame) -> DataFrame:
    """Everything :func:`extract.extract_pages` leaves out."""
    return quarantine_rows(extract_pages(pages, columns=["fault", "video_fault", "lost_posts"]))


def extraction_counts(pages: DataFrame) -> DataFrame:
    """Per page: number of videos from the document, from the markup, and kept."""
    extracted = extract_pages(pages, columns=["videos", "video_source", "json_videos"])
    total = F.coalesce(F.size("videos"), F.lit(0))
    from_html = F.when(F.col("video_source") == "html", total).otherwise(0)
    return extracted.select(
        "path",
        F.col("json_videos").alias("json_videos"),
        from_html.alias("html_videos"),
        total.alias("videos"),
    )


def observed(extracted: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and counts that are filled in while they are written."""
    counts = Observation()
    return (
        extracted.observe(
            counts,
            F.count("*").alias("pages"),
            F.count("fault").alias("faults"),
            F.count("profile").alias("profiles"),
            F.coalesce(F.sum(F.size("videos")), F.lit(0)).alias("videos"),
            F.coalesce(F.sum("lost_posts"), F.lit(0)).alias("lost_posts"),
        ),
        counts,
    )


def filter_invalid_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles whose key names a creator: not null, not empty, not the default text."""
    return profiles.filter(F.col(PROFILE_KEY).isNotNull() & ~F.col(PROFILE_KEY).isin("", "N/A"))


def reject_null_keys(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may enter a keyed table, and rows that may not."""
    return rows.filter(F.col(key).isNotNull()), rows.filter(F.col(key).isNull())
