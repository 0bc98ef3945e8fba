"""Table schemas, and the fixed values the extraction results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("username", T.StringType(), False),
        T.StructField("user_id", T.StringType()),
        T.StructField("actual_name", T.StringType()),
        T.StructField("following_count", T.LongType()),
        T.StructField("follower_count", T.LongType()),
        T.StructField("total_like_count", T.LongType()),
        T.StructField("caption", T.StringType()),
        T.StructField("bio_link", T.StringType()),
        T.StructField("bio", T.StringType()),
        T.StructField("profile_pic_url", T.StringType()),
        T.StructField("is_verified", T.BooleanType()),
        T.StructField("scrape_timestamp", T.TimestampType()),
    ]
)

VIDEO_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("views", T.LongType()),
        T.StructField("thumbnail", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("create_time", T.StringType()),
        T.StructField("like_count", T.LongType()),
        T.StructField("comment_count", T.LongType()),
        T.StructField("share_count", T.LongType()),
    ]
)

PROFILE_COLUMNS = PROFILE_SCHEMA.fieldNames()
VIDEO_COLUMNS = VIDEO_SCHEMA.fieldNames()
PROFILE_KEY = "username"
VIDEO_KEY = "url"

# What a field holds when the page does not give it.
PROFILE_DEFAULTS = {
    "username": "N/A",
    "user_id": "N/A",
    "actual_name": "Unknown",
    "following_count": 0,
    "follower_count": 0,
    "total_like_count": 0,
    "caption": "N/A",
    "bio_link": "No link",
    "bio": "N/A",
    "profile_pic_url": "N/A",
    "is_verified": False,
}
VIDEO_DEFAULTS = {
    "views": 0,
    "thumbnail": "N/A",
    "description": "N/A",
    "create_time": "N/A",
    "like_count": 0,
    "comment_count": 0,
    "share_count": 0,
}

# Places in the page and in its embedded document.
SCRIPT_ID = "__UNIVERSAL_DATA_FOR_REHYDRATION__"
SCOPE_KEY = "__DEFAULT_SCOPE__"
DETAIL_KEY = "webapp.user-detail"
ITEM_MODULE_KEY = "ItemModule"
VIDEO_URL_BASE = "https://www.tiktok.com"
CLASS_FEED = "tiktok-.*-DivVideoFeed"
CLASS_DESC = "tiktok-.*-desc"
CLASS_STATS = "tiktok-.*-stats"
