"""Creator pages rendered from the given tables, and a scrape log from the events.

A customer is a creator and its orders are the posts. ``c_custkey % 12`` picks
the shape of the creator's pages, so that each way of reading a page occurs.
A creator with many orders gets many pages (about ``POSTS_PER_PAGE`` posts on
each), so that no page grows with the data. Followers rise from page to page, and
every fifth post is on the page before its own too, with other numbers, so that it
matters which page is the last. Pages are written once per session
and folder as a landing table; queries then read that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.functions import text as tx
from reelbook.schemas import SCRIPT_ID
from reelbook.session import scratch_dir
from reelbook.sources import landing

POSTS_PER_PAGE = 10
#: Files of the landing table at least, so that a stream over it has several batches.
LANDED_FILES = 4
#: A batch is one file, and a row group is read by one task: several of them keep all cores busy.
ROW_GROUP_BYTES = 16 << 20
SHAPES = 12

#: Scattered numbers are a permutation of the numbers below this prime.
ARRIVALS = 1000000007

_landed: dict[tuple[str, str], str] = {}


def _scatter(number: Column) -> Column:
    """A spread-out number for a key, in arithmetic that SQL can repeat and that cannot overflow.

    Keys that differ by a multiple of the prime tie; whoever orders by it adds the key.
    """
    return number % ARRIVALS * 387420489 % ARRIVALS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with the number of its orders."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    return (
        table(spark, sf_dir, "customer")
        .join(orders.agg(F.count("*").alias("n")), "c_custkey", "left")
        .select(
            "c_custkey",
            "c_name",
            F.col("c_nationkey").cast("bigint").alias("following"),
            F.abs(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("followers"),
            F.coalesce("n", F.lit(0)).alias("n"),
            "c_mktsegment",
            (F.col("c_custkey") % 11 < 6).alias("verified"),
        )
    )


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page with its posts in key order.

    Orders are spread over the pages of a creator before they are collected; the
    explicit exchange lets a skewed creator be split in the join before it.
    """
    people = creators(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("c_custkey"),
        F.floor("o_totalprice").cast("bigint").alias("views"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("created"),
        "o_orderpriority",
    )
    page_count = F.ceil(F.col("n") / POSTS_PER_PAGE).cast("bigint")
    spread = (
        orders.join(people, "c_custkey")
        .withColumn("chunk", _scatter(F.col("o_orderkey")) % page_count)
        .withColumn("earlier", (F.col("o_orderkey") % 5 == 0) & (F.col("chunk") > 0))
        .withColumn("back", F.explode(F.expr("IF(earlier, array(0, 1), array(0))")))
        .withColumns({"chunk": F.col("chunk") - F.col("back"), "views": F.col("views") + 7 * F.col("back")})
        .drop("earlier", "back")
        .repartition("c_custkey", "chunk")
    )
    post = F.struct("o_orderkey", "views", "created", "o_orderpriority")
    full = spread.groupBy(*people.columns, "chunk").agg(
        F.sort_array(F.collect_list(post)).alias("posts")
    )
    empty = people.filter("n = 0").select(
        "*",
        F.lit(0).cast("bigint").alias("chunk"),
        F.array().cast(full.schema["posts"].dataType).alias("posts"),
    )
    return full.unionByName(empty).withColumn("followers", F.col("followers") + F.col("chunk"))


def render_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, html, time_created`` for every page."""
    rows = page_posts(spark, sf_dir)
    shape = F.col("c_custkey") % SHAPES
    username = F.concat(F.lit("user"), F.col("c_custkey"))
    second = (F.col("c_custkey") + F.col("chunk") * 1000000).cast("bigint")
    created = F.timestamp_seconds(F.lit(1704067200) + second)
    return rows.select(
        tx.landing_path(username, created).alias("path"),
        _html(shape, username).alias("html"),
        created.alias("time_created"),
    )


def _json(struct: Column) -> Column:
    return F.to_json(struct, {"ignoreNullFields": "false"})


def _html(shape: Column, username: Column) -> Column:
    named = lambda **fields: F.struct(
        *[value.alias(name) for name, value in fields.items()]
    )
    cover = lambda key: F.concat(F.lit("https://img.example/v"), key, F.lit(".jpg"))
    avatar = F.concat(F.lit("https://img.example/u"), F.col("c_custkey"), F.lit(".jpg"))
    bio_link = F.concat(F.lit("https://link.example/u"), F.col("c_custkey"))
    null = lambda kind: F.lit(None).cast(kind)

    def post(p: Column, index: Column) -> Column:
        key = p["o_orderkey"].cast("string")
        created = F.when((shape == 10) & (index == 2), null("bigint")).otherwise(p["created"])
        views = p["views"]
        full = named(
            id=key,
            desc=p["o_orderpriority"],
            createTime=created,
            video=named(cover=cover(key)),
            stats=named(
                playCount=views,
                diggCount=F.floor(views / 10).cast("bigint"),
                commentCount=F.floor(views / 100).cast("bigint"),
                shareCount=F.floor(views / 1000).cast("bigint"),
            ),
        )
        sparse = F.concat(
            F.lit('{"id":"'), key, F.lit('","desc":null,"video":{},"stats":{"playCount":'),
            views.cast("string"), F.lit("}}"),
        )
        return F.when(shape == 11, sparse).otherwise(_json(full))

    listed = F.concat(F.lit("["), F.array_join(F.transform("posts", post), ","), F.lit("]"))
    keyed = F.transform(
        "posts",
        lambda p, index: F.concat(F.lit('"'), p["o_orderkey"], F.lit('":'), post(p, index)),
    )
    # the first key is there twice, and so is the map: the last of each counts
    stale = F.when(
        F.size("posts") > 0,
        F.concat(F.lit('"'), F.get("posts", F.lit(0))["o_orderkey"], F.lit('":{"id":"0","createTime":1},')),
    ).otherwise("")
    module = F.concat(F.lit("{"), stale, F.array_join(keyed, ","), F.lit("}"))
    user = F.when(
        shape == 11,
        F.concat(
            F.lit('{"uniqueId":"'), username, F.lit('","id":"'), F.col("c_custkey"),
            F.lit('","nickname":null,"bioLink":{},"bio":null}'),
        ),
    ).otherwise(
        _json(
            named(
                uniqueId=username,
                id=F.col("c_custkey").cast("string"),
                nickname=F.col("c_name"),
                signature=F.col("c_mktsegment"),
                bioLink=named(link=bio_link),
                bio=F.col("c_mktsegment"),
                avatarLarger=avatar,
                verified=F.col("verified"),
            )
        )
    )
    stats = F.when(shape == 11, F.lit('{"followingCount":null}')).otherwise(
        F.concat(
            F.lit('{"followingCount":'), F.col("following"),
            F.lit(',"followerCount":'), F.col("followers"),
            F.lit(',"heartCount":'), F.col("n"),
            F.when(shape == 3, F.concat(F.lit(',"videoList":'), listed)).otherwise(""),
            F.lit("}"),
        )
    )
    info = F.when(shape == 6, F.lit("")).otherwise(
        F.concat(F.lit('"userInfo":{"user":'), user, F.lit(',"stats":'), stats, F.lit("},"))
    )
    lists = (
        F.when(shape == 1, F.concat(F.lit('"posts":[],"itemList":'), listed))
        .when(shape == 2, F.concat(F.lit('"ItemList":'), listed))
        .when(shape == 3, F.lit('"posts":[],"itemList":[]'))
        .when(shape == 4, F.lit('"posts":null'))
        .otherwise(F.concat(F.lit('"posts":'), listed))
    )
    stale_map = ',"ItemModule":{"0":{"id":"0","createTime":1}},"ItemModule":'
    root = F.when(shape == 4, F.concat(F.lit(stale_map), module)).otherwise("")
    # what comes too early, and what comes too late
    broken = F.when(F.col("c_custkey") % 24 == 7, ",").otherwise("},5]")
    document = F.concat(
        F.lit('{"__DEFAULT_SCOPE__":{"webapp.user-detail":{'), info, lists, F.lit("}}"), root,
        F.when(shape == 7, broken).otherwise("}"),
    )
    # A commented copy and an earlier script must not be taken for the document.
    script = F.concat(
        F.lit(f'<!-- <script id="{SCRIPT_ID}">{{"old":1}}</script> -->'),
        F.lit(f'<script id="{SCRIPT_ID}" type="application/json">\n '), document,
        F.lit(" \n</script>"),
    )

    def tile(p: Column) -> Column:
        key, views = p["o_orderkey"], p["views"]
        return F.concat(
            F.lit('<a href="https://host.example/@'), username, F.lit("/video/"), key,
            F.lit('"><img src="'), cover(key), F.lit('"></a><strong data-e2e="video-views">'),
            F.format_number(views, 0),
            F.lit('</strong><div class="tiktok-1a-desc  big"> <p><b>'), p["o_orderpriority"],
            F.lit('</b>&nbsp;<br></div><div class="x tiktok-1a-stats"><strong data-e2e="like-count">'),
            F.floor(views / 10),
            F.lit('</strong><strong data-e2e="comment-count">'), F.floor(views / 100),
            F.lit('</strong><strong data-e2e="share-count">'), F.floor(views / 1000),
            F.lit("</strong></div>"),
        )

    head = F.concat(
        F.lit('<h2 data-e2e="user-subtitle">\n'), username, F.lit(' </h2><h1 data-e2e="user-title">'),
        F.col("c_name"), F.lit("</h1>"),
        *[
            F.concat(F.lit('<strong data-e2e="user-stats">'), count, F.lit("</strong> "))
            for count in (
                F.col("following").cast("string"),
                F.format_number("followers", 0),
                F.col("n").cast("string"),
            )
        ],
        F.lit('<h2 data-e2e="user-bio">'), F.col("c_mktsegment"),
        F.lit('</h2><a data-e2e="user-link" href="'), bio_link,
        F.lit('">x</a><img data-e2e="user-avatar" src="'), avatar, F.lit('">'),
        F.when(F.col("verified"), F.lit('<svg data-e2e="verify-badge"></svg>')).otherwise(""),
    )
    tiles = F.array_join(
        F.transform(
            "posts",
            lambda p: F.concat(F.lit('<div data-e2e="user-post-item">'), tile(p), F.lit("</div>")),
        ),
        "",
    )
    feed = F.concat(
        F.lit('<div class="tiktok-x-DivVideoFeed">'),
        F.array_join(F.transform("posts", tile), ""),
        F.lit("</div>"),
    )
    body = (
        F.when(shape == 5, F.concat(head, tiles))
        .when(shape == 6, F.concat(script, head))
        .when(shape == 8, F.lit("<p>nothing here"))
        .when(shape == 9, F.concat(head, feed))
        .otherwise(script)
    )
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var t='</p>';</script></head><body>"),
        body,
        F.lit("</body></html>"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table of rendered pages."""
    return landing.read_table(spark, landed_path(spark, sf_dir))


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a scrape log: profile records in shuffled arrival order."""
    username = F.concat(F.lit("user"), F.col("user_id"))
    every_tenth = F.col("event_id") % 10 == 0
    return table(spark, sf_dir, "events").select(
        _scatter(F.col("event_id")).alias("arrival"),
        username.alias("username"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("actual_name"),
        F.lit(0).cast("bigint").alias("following_count"),
        F.round(F.col("value") * 100).cast("bigint").alias("follower_count"),
        F.lit(0).cast("bigint").alias("total_like_count"),
        F.col("props").alias("caption"),
        F.lit("No link").alias("bio_link"),
        F.when(~every_tenth, F.col("event_type")).alias("bio"),
        F.lit("N/A").alias("profile_pic_url"),
        F.lit(False).alias("is_verified"),
        F.col("ts").cast("timestamp").alias("scrape_timestamp"),
    )


def video_scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations of videos: a video is a part of a supplier."""
    return table(spark, sf_dir, "lineitem").select(
        _scatter(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"),
        F.concat(
            F.lit("https://host.example/@user"), F.col("l_suppkey"),
            F.lit("/video/"), F.col("l_partkey"),
        ).alias("url"),
        F.round("l_extendedprice").cast("bigint").alias("views"),
        F.concat(F.lit("t"), F.col("l_orderkey")).alias("thumbnail"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linestatus")).alias("description"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("create_time"),
        F.col("l_quantity").cast("bigint").alias("like_count"),
        F.col("l_orderkey").alias("comment_count"),
        F.col("l_linenumber").cast("bigint").alias("share_count"),
    )


def landed_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the landing table of rendered pages, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        path = scratch_dir(spark, "pages")
        files = max(LANDED_FILES, spark.sparkContext.defaultParallelism)
        rows = render_pages(spark, sf_dir).repartition(files, "path")
        rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        _landed[key] = path
    return _landed[key]
