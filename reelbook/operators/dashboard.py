"""Result sets of the dashboard, over the ``profiles`` and ``videos`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelbook.schemas import VIDEO_DEFAULTS


def followers_per_creator(profiles: DataFrame) -> DataFrame:
    """Followers of each creator, most first."""
    return profiles.select("username", "follower_count").orderBy(
        F.desc_nulls_last("follower_count"), "username"
    )


def total_followers(profiles: DataFrame) -> DataFrame:
    return profiles.agg(F.sum("follower_count").alias("total_followers"))


def verified_share(profiles: DataFrame) -> DataFrame:
    """Creators per verification state and their percentage, to one decimal."""
    counts = profiles.groupBy("is_verified").agg(F.count("*").alias("creators"))
    # The window runs over the two or three aggregated rows.
    total = F.sum("creators").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(F.col("creators") * 100.0 / total, 1))


def followers_vs_likes(profiles: DataFrame) -> DataFrame:
    """One point per creator."""
    return profiles.select("username", "follower_count", "total_like_count")


def followers_likes_correlation(profiles: DataFrame) -> DataFrame:
    """Pearson correlation of the points, and their number."""
    return profiles.agg(
        F.round(F.corr("follower_count", "total_like_count"), 6).alias("correlation"),
        F.count_if(F.col("follower_count").isNotNull() & F.col("total_like_count").isNotNull())
        .cast("bigint")
        .alias("creators"),
    )


def create_date(create_time: Column) -> Column:
    """Day of an ISO create time; NULL for the default text."""
    return F.substring(create_time, 1, 10).try_cast("date")


def trend_by_day(videos: DataFrame) -> DataFrame:
    """Videos, views and likes by day of creation; videos without a time are left out."""
    return (
        videos.filter(F.col("create_time") != VIDEO_DEFAULTS["create_time"])
        .select(create_date(F.col("create_time")).alias("day"), "views", "like_count")
        .filter(F.col("day").isNotNull())
        .groupBy("day")
        .agg(
            F.count("*").alias("videos"),
            F.sum("views").alias("views"),
            F.sum("like_count").alias("likes"),
        )
    )


def follower_history(profile_log: DataFrame) -> DataFrame:
    """Last follower count of each creator and day, from all extracted profiles."""
    day = F.col("scrape_timestamp").cast("date")
    return profile_log.groupBy("username", day.alias("day")).agg(
        F.max(F.struct("scrape_timestamp", "follower_count"))["follower_count"].alias(
            "follower_count"
        ),
        F.count("*").alias("scrapes"),
    )


def _engagement(likes: Column, comments: Column, shares: Column, views: Column) -> Column:
    interactions = likes + comments + shares
    return F.when(views != 0, interactions.cast("double") / views.cast("double"))


def engagement_video(videos: DataFrame) -> DataFrame:
    """(likes + comments + shares) / views of each video; NULL without views."""
    rate = _engagement(*[F.col(c) for c in _INTERACTIONS], F.col("views"))
    return videos.select("url", rate.alias("engagement_rate"))


def video_creator(url: Column) -> Column:
    """Creator named in a video URL; NULL if there is none."""
    name = F.regexp_extract(url, "@([^/]+)/video/", 1)
    return F.when(name != "", name)


_INTERACTIONS = ("like_count", "comment_count", "share_count")


def creator_totals(videos: DataFrame) -> DataFrame:
    """Sums over the videos of each creator: the ``username`` of the page where that is a
    column and known, else the one named in the URL. Videos of nobody have a row with NULL."""
    named = video_creator(F.col("url"))
    if "username" in videos.columns:
        named = F.coalesce(F.nullif("username", F.lit("N/A")), F.nullif(named, F.lit("N/A")))
    return (
        videos.withColumn("username", F.nullif(named, F.lit("N/A")))
        .groupBy("username")
        .agg(
            F.count("*").alias("videos"),
            *[F.sum(name).alias(name) for name in ("views", *_INTERACTIONS)],
        )
    )


def engagement_creator(videos: DataFrame) -> DataFrame:
    """Engagement of each creator: sum of interactions over sum of views."""
    totals = creator_totals(videos)
    rate = _engagement(*[F.col(c) for c in _INTERACTIONS], F.col("views"))
    return totals.select("username", "videos", rate.alias("engagement_rate"))


def creator_video_rollup(videos: DataFrame, profiles: DataFrame) -> DataFrame:
    """Video sums of each creator with the creator's profile, if there is one.

    Videos are summed per creator before the join, so both sides have one row
    per key and a creator with very many videos does not skew it.
    """
    return (
        creator_totals(videos)
        .join(profiles.select("username", "follower_count", "is_verified"), "username", "left")
        .select("username", "follower_count", "is_verified", "videos", "views", "like_count")
    )


def top_videos(videos: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` videos with most views; equal views by URL."""
    return (
        videos.select("url", "views", "description")
        .orderBy(F.desc_nulls_last("views"), "url")
        .limit(k)
    )
