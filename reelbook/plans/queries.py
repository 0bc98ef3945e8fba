"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.functions import text as tx
from reelbook.functions import variants as vr
from reelbook.operators import dashboard, dom, extract, jsondoc, quality
from reelbook.operators.history import FollowerHistory
from reelbook.operators.upsert import LatestTable, latest, merge_upsert
from reelbook.plans import fixtures as fx
from reelbook.schemas import (
    PROFILE_COLUMNS,
    PROFILE_KEY,
    PROFILE_SCHEMA,
    SCRIPT_ID,
    VIDEO_KEY,
    VIDEO_URL_BASE,
)
from reelbook.session import configure, scratch_dir
from reelbook.sources import landing, messagelog, messages, processed
from reelbook.sources.objects import write_objects
from reelbook.streaming import audit, counts
from reelbook.streaming.counts import BatchCounts
from reelbook.streaming.ingest import CreatorStore, run_latest, start_ingest, start_landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under the name of its function."""

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir.rstrip("/"))

    QUERIES[run.__name__] = configured
    return run


def _wall(rows: DataFrame, *names: str) -> DataFrame:
    """Timestamps without time zone, as the given tables hold them."""
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


# --- messages, objects, names ------------------------------------------------------


@query
def trigger_decode(spark, sf):
    """Base64 payloads back to text, and the name after the last @."""
    said = fx.table(spark, sf, "conversations")
    sent = said.select(
        "conv_id", "turn", F.base64(F.col("text").cast("binary")).alias("data")
    )
    return messages.decode(sent).select("conv_id", "turn", "url", "username")


@query
def raw_page_scan(spark, sf):
    """One object per page: written, scanned whole, with object columns."""
    root = scratch_dir(spark, "objects")
    raw = fx.table(spark, sf, "pages").select(
        F.concat(F.lit("page"), F.col("page_id")).alias("creator"), "html"
    )
    write_objects(raw, root, "creator")
    found = landing.object_columns(landing.read_objects(spark, root, "*.txt"), root)
    text = F.substring(F.col("html"), F.lit(1), F.length("html") - 1)  # the writer ends the line
    folder = F.substring_index(tx.path_username(F.col("name")), "=", -1)
    return found.select(
        folder.alias("creator"),
        F.length(text).cast("bigint").alias("chars"),
        F.md5(text).alias("html_md5"),
        F.col("time_created").isNotNull().alias("has_time"),
    )


@query
def url_username(spark, sf):
    """Creator names of page URLs and of profile URLs."""
    profile_url = F.concat(F.lit(f"{VIDEO_URL_BASE}/@user"), F.col("c_custkey"))
    urls = fx.table(spark, sf, "pages").select("url").unionAll(
        fx.table(spark, sf, "customer").select(profile_url.alias("url"))
    )
    return urls.select("url", tx.url_username(F.col("url")).alias("username"))


@query
def path_username(spark, sf):
    """Creator folders of landed pages, and of URLs read as paths."""
    paths = fx.pages(spark, sf).select("path").unionAll(
        fx.table(spark, sf, "pages").select(F.col("url").alias("path"))
    )
    return paths.select("path", tx.path_username(F.col("path")).alias("username"))


@query
def landing_path(spark, sf):
    """Object names of raw pages and of extraction results."""
    username = F.concat(F.lit("user"), F.col("user_id"))
    at = F.col("ts")
    return fx.table(spark, sf, "events").select(
        "event_id",
        tx.landing_path(username, at).alias("landing"),
        tx.processed_path("profiles", username, at).alias("profile_json"),
        tx.processed_path("videos", username, at).alias("video_json"),
    )


@query
def landing_dedupe(spark, sf):
    """Pages landed at the same path: the later one is kept."""
    username = F.concat(F.lit("user"), F.col("user_id"))
    landed = fx.table(spark, sf, "events").select(
        tx.landing_path(username, F.date_trunc("hour", "ts")).alias("path"),
        F.col("props").alias("html"),
        F.col("ts").cast("timestamp").alias("time_created"),
    )
    return _wall(landing.last_landed(landed), "time_created")


@query
def digits_to_long(spark, sf):
    """Digits of names, formatted amounts and amounts with a suffix."""
    balance = F.format_number("c_acctbal", 2)
    return fx.table(spark, sf, "customer").select(
        "c_custkey",
        tx.digits_to_long(F.col("c_name")).alias("from_name"),
        tx.digits_to_long(balance).alias("from_amount"),
        tx.digits_to_long(F.concat(F.format_number("c_nationkey", 0), F.lit(".2M"))).alias(
            "from_suffix"
        ),
        tx.digits_to_long(F.col("c_mktsegment")).alias("from_words"),
    )


@query
def epoch_to_iso(spark, sf):
    """Order dates through epoch seconds to ISO text; milliseconds are out of range."""
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        tx.epoch_to_iso(seconds).alias("iso"),
        tx.epoch_to_iso(seconds * 1000000).alias("iso_of_micros"),
    )


# --- the embedded document ---------------------------------------------------------


@query
def json_script(spark, sf):
    """Which pages embed a document, and how it begins and ends."""
    body = tx.strip(jsondoc.script_body(F.col("html")))
    return fx.pages(spark, sf).select("path", body.alias("body")).select(
        "path",
        F.col("body").isNotNull().alias("has_script"),
        F.substring("body", 1, 20).alias("head"),
        F.regexp_count("body", F.lit('"desc":')).cast("bigint").alias("posts"),
    )


@query
def json_malformed(spark, sf):
    """Pages whose document is not one JSON value."""
    body = tx.strip(jsondoc.script_body(F.col("html")))
    parsed = fx.pages(spark, sf).select("path", body.alias("body"))
    parsed = parsed.withColumn("doc", jsondoc.parse(F.col("body")))
    whole = jsondoc.is_whole(F.col("doc"), F.col("body"))
    return parsed.select("path", (F.col("body").isNotNull() & ~whole).alias("malformed"))


@query
def json_scope_gate(spark, sf):
    """Whether a page has a document that holds a user detail."""
    read = extract.read_document(fx.pages(spark, sf))
    return read.select("path", F.coalesce("gate", F.lit(False)).alias("gate"))


@query
def json_field_default(spark, sf):
    """Event properties: a key that is there, and a missing one with its default."""
    doc = F.try_parse_json("props")
    read = fx.table(spark, sf, "events").select(
        "event_id", vr.object_of(doc, "k", "absent").alias("p")
    )
    return read.select(
        "event_id",
        vr.default_if_missing(F.col("p.k"), 0, "bigint").alias("k"),
        vr.default_if_missing(F.col("p.absent"), "N/A", "string").alias("absent"),
        vr.truthy(F.col("p.k")).alias("k_truthy"),
        vr.loads_as(F.col("p.k"), "boolean").alias("k_is_flag"),
    )


def _shaped_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per event with a document whose shape depends on the event number."""
    name = F.concat(F.lit("user"), F.col("user_id"))
    user = lambda more: F.concat(
        F.lit('{"uniqueId":"'), name, F.lit('"'), F.lit(more), F.lit("}")
    )
    info = lambda who, stats: F.concat(
        F.lit('{"user":'), who, F.lit(f',"stats":{stats}}}')
    )
    detail = lambda value: F.concat(
        F.lit('{"__DEFAULT_SCOPE__":{"webapp.user-detail":'), value, F.lit("}}")
    )
    of_info = lambda value: detail(F.concat(F.lit('{"userInfo":'), value, F.lit("}")))
    good = of_info(info(user(""), "{}"))
    shapes = [
        good,
        detail(F.lit("null")),
        of_info(F.lit("null")),
        of_info(info(F.lit("[]"), "{}")),
        of_info(info(user(""), "null")),
        of_info(info(user(',"bioLink":null'), "{}")),
        F.lit("5"),
        F.lit('{"__DEFAULT_SCOPE__":null}'),
        F.lit("[]"),
        F.concat(good, F.lit(" ;")),
        of_info(info(F.lit('{"uniqueId":null}'), "{}")),
        of_info(info(user(""), '{"followerCount":2.5}')),
        of_info(info(user(""), '{"followerCount":true}')),
    ]
    document = F.element_at(F.array(*shapes), (F.col("event_id") % len(shapes) + 1).cast("int"))
    # one file may hold all events; each becomes a page
    tasks = max(8, spark.sparkContext.defaultParallelism)
    return fx.table(spark, sf, "events").repartition(tasks, "event_id").select(
        F.concat(F.lit("profiles/"), name, F.lit("/"), F.col("event_id"), F.lit(".html")).alias(
            "path"
        ),
        F.concat(F.lit(f"<script id={SCRIPT_ID}>"), document, F.lit("</script>")).alias("html"),
        F.col("ts").cast("timestamp").alias("time_created"),
    )


@query
def json_shape_guard(spark, sf):
    """Documents with a null, a list or a number in place of an object, and unloadable values."""
    return extract.extract_pages(_shaped_pages(spark, sf), columns=["fault"]).select("path", "fault")


@query
def extract_profile_json(spark, sf):
    """Profiles as the document gives them."""
    return extract.json_profiles(fx.pages(spark, sf))


@query
def extract_videos_json(spark, sf):
    """Videos as the document gives them."""
    return extract.json_videos(fx.pages(spark, sf)).drop("position")


@query
def video_source_chain(spark, sf):
    """Posts of each page in order, from the first of the five places that has any."""
    read = extract.from_json(fx.pages(spark, sf))
    ids = F.transform("posts", lambda post: vr.text_of(post["id"]))
    return read.select(
        "path",
        F.coalesce(F.size("posts"), F.lit(0)).cast("bigint").alias("posts"),
        F.coalesce(F.array_join(ids, ","), F.lit("")).alias("ids"),
    )


@query
def video_prefix_truncation(spark, sf):
    """Posts read and posts lost from the first unreadable one on."""
    read = extract.from_json(fx.pages(spark, sf))
    return read.select(
        "path",
        F.coalesce(F.size("readable"), F.lit(0)).cast("bigint").alias("readable"),
        F.col("lost_posts").cast("bigint").alias("lost"),
    )


# --- markup ---------------------------------------------------------------------------


def _raw(spark: SparkSession, sf: str, tags=None, attrs=()) -> DataFrame:
    raw = fx.table(spark, sf, "pages")
    return raw.select("page_id", dom.page_nodes(F.col("html"), tags, attrs).alias("page"))


@query
def html_nodes_count(spark, sf):
    """Nodes of the raw pages by tag."""
    nodes = _raw(spark, sf).select("page_id", F.explode("page.nodes.tag").alias("tag"))
    return nodes.groupBy("page_id", "tag").agg(F.count("*").alias("nodes"))


@query
def html_text_strip(spark, sf):
    """Text of the heading of each raw page."""
    heading = dom.find_first(F.col("page.nodes"), dom.where("h1"))
    read = _raw(spark, sf, ["h1"]).select("page_id", "page", heading.alias("h1"))
    return read.select("page_id", dom.node_text(F.col("page"), F.col("h1")).alias("h1"))


@query
def html_find_first(spark, sf):
    """First link of each raw page."""
    first = dom.find_first(F.col("page.nodes"), dom.where("a"))
    read = _raw(spark, sf, ["a"], ["href"]).select("page_id", "page", first.alias("a"))
    return read.select(
        "page_id",
        dom.attr(F.col("a"), "href").alias("href"),
        dom.node_text(F.col("page"), F.col("a")).alias("text"),
    )


@query
def html_find_all(spark, sf):
    """Number of list items, the third one's text, and the hundredth one's."""
    items = dom.find_all(F.col("page.nodes"), dom.where("li"))
    read = _raw(spark, sf, ["li"]).select("page_id", "page", items.alias("items"))
    text = lambda k: dom.node_text(F.col("page"), F.get("items", F.lit(k)))
    return read.select(
        "page_id",
        F.size("items").cast("bigint").alias("items"),
        text(2).alias("third"),
        F.coalesce(text(99), F.lit("none")).alias("hundredth"),
    )


@query
def html_attr(spark, sf):
    """Every link of the raw pages: its place, its href and an attribute it lacks."""
    read = _raw(spark, sf, ["a"], ["href", "rel"])
    links = read.select("page_id", F.posexplode("page.nodes").alias("place", "a"))
    return links.select(
        "page_id",
        F.col("place").cast("bigint").alias("place"),
        dom.attr(F.col("a"), "href").alias("href"),
        dom.attr(F.col("a"), "rel").isNull().alias("no_rel"),
    )


@query
def html_class_regex(spark, sf):
    """Blocks by class pattern: on raw pages the advertisement boxes."""
    boxes = dom.find_all(F.col("page.nodes"), dom.where("div", class_like="^a.?d"))
    return _raw(spark, sf, ["div"], ["class"]).select(
        "page_id",
        F.size(boxes).cast("bigint").alias("boxes"),
        dom.class_text(F.get(boxes, F.lit(0))).alias("first_class"),
    )


@query
def extract_profile_html(spark, sf):
    """Profiles as the markup gives them, from all pages."""
    return extract.html_profiles(fx.pages(spark, sf)).drop("failed_step")


@query
def extract_videos_html(spark, sf):
    """Videos as the markup gives them, from all pages."""
    return extract.html_videos(fx.pages(spark, sf)).drop("position")


@query
def html_profile_freeze(spark, sf):
    """Profiles from markup with one broken part: later fields keep their defaults."""
    broken = F.col("c_custkey") % 6
    count = lambda step, value: F.concat(
        F.lit('<strong data-e2e="user-stats">'),
        F.when(broken == step, F.lit("none")).otherwise(value.cast("string")),
        F.lit("</strong>"),
    )
    html = F.concat(
        F.lit('<h2 data-e2e="user-subtitle">'), F.col("c_name"), F.lit("</h2>"),
        count(1, F.col("c_nationkey")), count(2, F.col("c_custkey")), count(3, F.col("c_custkey")),
        F.lit('<h2 data-e2e="user-bio">'), F.col("c_mktsegment"), F.lit("</h2>"),
        F.when(broken == 4, F.lit('<a data-e2e="user-link">')).otherwise(
            F.lit('<a data-e2e="user-link" href="/me">')
        ),
        F.when(broken == 5, F.lit('<img data-e2e="user-avatar">')).otherwise(
            F.lit('<img data-e2e="user-avatar" src="me.jpg">')
        ),
        F.lit('<svg data-e2e="verify-badge"/>'),
    )
    pages = fx.table(spark, sf, "customer").select(
        F.concat(F.lit("p/"), F.col("c_custkey")).alias("path"), html.alias("html")
    )
    return extract.html_profiles(pages)


@query
def html_alt_container(spark, sf):
    """Post containers and, where there is none, feed containers."""
    read = fx.pages(spark, sf).select("path", dom.creator_nodes(F.col("html")).alias("page"))
    posts = dom.find_all(F.col("page.nodes"), dom.where("div", data_e2e="user-post-item"))
    feeds = dom.find_all(F.col("page.nodes"), dom.where("div", class_like=dom.CLASS_FEED))
    return read.select(
        "path",
        F.size(posts).cast("bigint").alias("posts"),
        F.size(feeds).cast("bigint").alias("feeds"),
    )


# --- whole pages ------------------------------------------------------------------------


@query
def fallback_profile(spark, sf):
    """Where each page's profile came from."""
    done = extract.extract_pages(fx.pages(spark, sf), columns=["profile_source", "profile"])
    return done.select("path", "profile_source", F.col("profile.username").alias("username"))


@query
def fallback_videos(spark, sf):
    """Where each page's videos came from, and how many there are."""
    done = extract.extract_pages(fx.pages(spark, sf), columns=["video_source", "videos"])
    videos = F.coalesce(F.size("videos"), F.lit(0)).cast("bigint")
    return done.select("path", "video_source", videos.alias("videos"))


@query
def quarantine_reasons(spark, sf):
    """What was left out, by reason."""
    out = quality.quarantine(fx.pages(spark, sf))
    return out.groupBy("scope", "reason").agg(
        F.count("*").alias("entries"), F.sum("lost").alias("lost")
    )


@query
def extraction_counts(spark, sf):
    """Videos per page by source."""
    counts = quality.extraction_counts(fx.pages(spark, sf))
    names = ("json_videos", "html_videos", "videos")
    return counts.select("path", *[F.col(name).cast("bigint").alias(name) for name in names])


@query
def page_profiles(spark, sf):
    """One profile per usable page, before the merge."""
    return _wall(extract.extract_profiles(fx.pages(spark, sf)), "scrape_timestamp")


@query
def page_videos(spark, sf):
    """All videos of all usable pages, before the merge."""
    return extract.extract_videos(fx.pages(spark, sf))


@query
def filter_invalid_profiles(spark, sf):
    """Extracted profiles that name a creator."""
    found = quality.filter_invalid_profiles(extract.extract_profiles(fx.pages(spark, sf)))
    return found.select("username", "actual_name", "follower_count")


@query
def ndjson_profiles(spark, sf):
    """Profiles written as JSON lines and read back with their schema."""
    path = scratch_dir(spark, "profiles-json")
    processed.write_json(extract.extract_profiles(fx.pages(spark, sf)), path)
    return _wall(processed.read_json(spark, path, "profiles"), "scrape_timestamp")


@query
def ndjson_roundtrip(spark, sf):
    """Videos written as JSON lines and read back with their schema."""
    path = scratch_dir(spark, "videos-json")
    processed.write_json(extract.extract_videos(fx.pages(spark, sf)), path)
    return processed.read_json(spark, path, "videos")


# --- latest state -------------------------------------------------------------------------


def _log_columns(rows: DataFrame) -> DataFrame:
    return _wall(rows.select(*PROFILE_COLUMNS), "scrape_timestamp")


@query
def latest_profile(spark, sf):
    """Scrape log to one row per creator, by scrape time."""
    return _log_columns(latest(fx.scrapes(spark, sf), PROFILE_KEY, ["scrape_timestamp"]))


@query
def latest_profile_arrival(spark, sf):
    """Scrape log to one row per creator, by arrival: an old scrape may overwrite a new one."""
    return _log_columns(latest(fx.scrapes(spark, sf), PROFILE_KEY, ["arrival"]))


@query
def merge_profiles(spark, sf):
    """Second half of the scrape log merged into the state after the first half."""
    log = fx.scrapes(spark, sf)
    first = F.col("arrival") < fx.ARRIVALS // 2
    target = latest(log.filter(first), PROFILE_KEY, ["arrival"]).drop("arrival")
    return _log_columns(merge_upsert(target, log.filter(~first), PROFILE_KEY, ["arrival"]))


@query
def merge_videos(spark, sf):
    """The same for observations of videos."""
    log = fx.video_scrapes(spark, sf)
    first = F.col("arrival") < fx.ARRIVALS // 2
    order = ["arrival"]
    target = latest(log.filter(first), VIDEO_KEY, order).drop("arrival")
    return merge_upsert(target, log.filter(~first), VIDEO_KEY, order)


@query
def latest_table(spark, sf):
    """Scrape log taken in three batches, published in between, later scrapes winning."""
    table = LatestTable(
        spark, scratch_dir(spark, "table"), PROFILE_SCHEMA, PROFILE_KEY, "event_time"
    )
    log = fx.scrapes(spark, sf).withColumns(
        {
            "page_time": F.col("scrape_timestamp"),
            "page_path": F.col("username"),
            "position": F.lit(0),
        }
    )
    for batch_id in range(3):
        table.append(log.filter(F.col("arrival") % 3 == batch_id), batch_id)
        if batch_id == 1:
            table.publish()
    return _wall(table.current(), "scrape_timestamp")


@query
def stream_latest(spark, sf):
    """Scrape log as a stream of files, latest state per creator by arrival."""
    log = fx.scrapes(spark, sf)
    source = scratch_dir(spark, "scrape-files")
    log.repartition(4, "arrival").write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    state = run_latest(
        stream, PROFILE_KEY, ["arrival"], scratch_dir(spark, "state"), scratch_dir(spark, "ckpt")
    )
    return _log_columns(state)


def _store(spark: SparkSession, sf: str) -> CreatorStore:
    """Landed pages streamed into a store file by file, published now and then."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        landed = fx.landed_path(spark, sf)
        store = CreatorStore(spark, scratch_dir(spark, "store"), order="event_time")
        stream = landing.stream_table(spark, landed, files_per_batch=1)
        start_ingest(stream, store, scratch_dir(spark, "ckpt"), publish_every=2).awaitTermination()
        store.publish()
        _stores[key] = store
    return _stores[key]


_stores: dict[tuple[str, str], CreatorStore] = {}


@query
def stream_profiles(spark, sf):
    """Landed pages streamed to the profile table; a creator's last page wins in any batching."""
    return _wall(_profiles(spark, sf), "scrape_timestamp")


@query
def stream_videos(spark, sf):
    """Landed pages streamed to the video table; the last page of a video wins."""
    return _store(spark, sf).videos.current()


@query
def stream_two_feeds(spark, sf):
    """Two folders of pages, each a stream with a checkpoint of its own, into one store."""
    pages = fx.pages(spark, sf)
    half = F.xxhash64("path") % 2 == 0
    store = CreatorStore(spark, scratch_dir(spark, "store"), order="event_time")
    for part in (half, ~half):
        folder = scratch_dir(spark, "feed")
        pages.filter(part).repartition(2, "path").write.parquet(folder)
        stream = landing.stream_table(spark, folder, files_per_batch=1)
        start_ingest(stream, store, scratch_dir(spark, "ckpt")).awaitTermination()
        store.publish()
    found = quality.filter_invalid_profiles(store.profiles.current())
    return _wall(found, "scrape_timestamp")


@query
def object_stream(spark, sf):
    """One object per page, read as a stream that ends when all are taken."""
    root, out = scratch_dir(spark, "objects"), scratch_dir(spark, "taken")
    raw = fx.table(spark, sf, "pages").select(
        F.concat(F.lit("page"), F.col("page_id")).alias("creator"), "html"
    )
    write_objects(raw, root, "creator")
    found = landing.stream_objects(spark, root, "*.txt", files_per_batch=1000)
    writer = found.writeStream.format("parquet").option("path", out)
    writer = writer.option("checkpointLocation", scratch_dir(spark, "ckpt"))
    writer.trigger(availableNow=True).start().awaitTermination()
    taken = landing.read_table(spark, out)
    text = F.substring(F.col("html"), F.lit(1), F.length("html") - 1)  # the writer ends the line
    folder = F.substring_index(tx.path_username(F.col("path")), "=", -1)
    return taken.select(folder.alias("creator"), F.md5(text).alias("html_md5"))


@query
def object_arrivals(spark, sf):
    """One object per page in one folder; the stream reads arrival records and fetches what they name."""
    root, work = scratch_dir(spark, "objects"), scratch_dir(spark, "arrivals")
    raw = fx.table(spark, sf, "pages").select("html")
    tasks = max(4, spark.sparkContext.defaultParallelism)
    write_objects(raw.repartition(tasks, "html"), root)
    there = landing.read_objects(spark, root, "*.txt").select("path", F.col("time_created").alias("event_time"))
    there.repartition(3, "path").write.json(f"{work}/records")

    def write(batch: DataFrame, batch_id: int) -> None:
        landing.named_objects(batch).write.mode("overwrite").parquet(f"{work}/taken/batch={batch_id}")

    stream = landing.stream_arrivals(spark, f"{work}/records", files_per_batch=1)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", scratch_dir(spark, "ckpt"))
    writer.trigger(availableNow=True).start().awaitTermination()
    text = F.substring(F.col("html"), F.lit(1), F.length("html") - 1)  # the writer ends the line
    taken = landing.read_table(spark, f"{work}/taken")
    return taken.select(F.md5(text).alias("html_md5"), F.length(text).cast("bigint").alias("chars"))


@query
def message_log(spark, sf):
    """Turns of conversations as messages of a log, streamed with a restart in the middle."""
    log, out, checkpoint = (scratch_dir(spark, name) for name in ("log", "taken", "ckpt"))
    stream = messages.decode(messagelog.stream_log(spark, log))
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    sent = fx.table(spark, sf, "conversations").select(
        F.base64(F.concat_ws(":", "conv_id", "turn", "role", F.md5("text")).cast("binary")).alias("data"),
        F.timestamp_seconds(F.lit(1717200000) + F.col("turn")).alias("publish_time"),
    )
    for part in (0, 1):
        messagelog.append_messages(sent.where(F.crc32("data") % 2 == part), log, 2, first=2 * part)
        writer.trigger(availableNow=True).start().awaitTermination()  # goes on where it ended
    return spark.read.parquet(out).select(F.col("url").alias("message"), F.unix_seconds("publish_time").alias("seconds"))


@query
def overwrite_audit(spark, sf):
    """Scrape log streamed in three arrival stretches: where an older scrape replaced a newer one."""
    log = fx.scrapes(spark, sf).select("username", "arrival", "scrape_timestamp")
    source, out = scratch_dir(spark, "scrape-files"), scratch_dir(spark, "audit")
    third = fx.ARRIVALS // 3 + 1
    for part in range(3):
        rows = log.where(F.floor(F.col("arrival") / third) == part)
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    writer = audit.overwrites(stream).writeStream.format("parquet").option("path", out).outputMode("append")
    writer.option("checkpointLocation", scratch_dir(spark, "ckpt")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(audit.OVERWRITES).parquet(out).transform(_wall, "scrape_timestamp", "replaced_timestamp")


@query
def batch_counts(spark, sf):
    """Counts of each batch of streamed pages, as a listener wrote them, summed up."""
    listener = BatchCounts(spark, scratch_dir(spark, "counts"))
    spark.streams.addListener(listener)
    try:
        stream = landing.stream_table(spark, fx.landed_path(spark, sf), files_per_batch=3)
        found = counts.observed(extract.extract_pages(landing.spread(stream)))
        writer = found.writeStream.format("noop").option("checkpointLocation", scratch_dir(spark, "ckpt"))
        writer.trigger(availableNow=True).start().awaitTermination()
        table = listener.table()
    finally:
        spark.streams.removeListener(listener)
    return table.agg(*[F.sum(name).alias(name) for name in ("pages", "profiles", "videos", "lost_posts")])


@query
def catalog_upsert(spark, sf):
    """Observations of videos in two halves upserted into a catalog table; the last of a video wins."""
    database = f"creators_{uuid.uuid4().hex}"
    processed.create_tables(spark, database, scratch_dir(spark, "catalog"), buckets=16)
    log = fx.video_scrapes(spark, sf)
    first = F.col("arrival") < fx.ARRIVALS // 2
    for half in (first, ~first):
        processed.upsert_table(log.where(half), f"{database}.videos", VIDEO_KEY, ["arrival"])
    return spark.table(f"{database}.videos").drop(processed.BUCKET)


@query
def history_state(spark, sf):
    """Follower history folded from three batches of pages, one of them twice."""
    pages = extract.extract_pages(fx.pages(spark, sf), columns=["profile"])
    log = quality.filter_invalid_profiles(
        extract.profile_rows(pages.withColumnRenamed("path", "page_path"), "page_path")
    )
    path = scratch_dir(spark, "profiles")
    log.write.parquet(path)  # the pages are read once
    log = spark.read.schema(log.schema).parquet(path)
    history = FollowerHistory(spark, scratch_dir(spark, "history"))
    for part in (0, 1, 2, 1):
        history.fold(log.where(F.pmod(F.xxhash64("page_path"), F.lit(3)) == part))
    return history.current()


@query
def stream_chain(spark, sf):
    """Messages to landed pages to the profile table: two streams joined by the landing folder."""
    url = F.concat(F.lit(f"{VIDEO_URL_BASE}/@user"), F.col("c_custkey"))
    bad = F.when(F.col("c_custkey") % 50 == 1, "!").otherwise("")
    sent = fx.table(spark, sf, "customer").select(
        F.concat(F.base64(url.cast("binary")), bad).alias("data"),
        F.timestamp_seconds(F.lit(1717200000) + F.col("c_custkey")).alias("publish_time"),
    )
    source = scratch_dir(spark, "messages")
    sent.repartition(2, "data").write.json(source)
    pages = fx.pages(spark, sf).withColumn("username", tx.path_username(F.col("path")))
    last = latest(pages, "username", ["time_created"]).select("username", "html")
    last.write.parquet(kept := scratch_dir(spark, "web"))  # once, not for each batch of messages
    web = spark.read.schema(last.schema).parquet(kept)

    def fetch(wanted: DataFrame) -> DataFrame:
        named = wanted.withColumn("username", tx.url_username(F.col("url")))
        return named.join(web, "username").select("url", "html", F.col("publish_time").alias("fetched_at"))

    landed = scratch_dir(spark, "landed")
    messages_in = messages.stream_messages(spark, source, files_per_batch=1)
    start_landing(messages_in, fetch, landed, scratch_dir(spark, "ckpt")).awaitTermination()
    store = CreatorStore(spark, scratch_dir(spark, "store"))
    start_ingest(landing.stream_table(spark, landed), store, scratch_dir(spark, "ckpt")).awaitTermination()
    rejected = spark.read.schema(messages.MESSAGE_SCHEMA).parquet(f"{landed}-rejected")
    profiles = quality.filter_invalid_profiles(store.profiles.current())
    return profiles.select("username", "follower_count", "scrape_timestamp").unionByName(
        rejected.select(
            F.lit("rejected").alias("username"), F.lit(None).cast("bigint").alias("follower_count"),
            F.col("publish_time").alias("scrape_timestamp"),
        )
    ).transform(_wall, "scrape_timestamp")


@query
def catalog_tables(spark, sf):
    """Tables created in the catalog and filled from the store; a second filling replaces the first."""
    database = f"creators_{uuid.uuid4().hex}"
    processed.create_tables(spark, database, scratch_dir(spark, "catalog"))
    rows = _videos(spark, sf)
    for _ in range(2):
        processed.publish_table(rows, f"{database}.videos")
    return spark.table(f"{database}.videos")


@query
def profile_history(spark, sf):
    """Follower count of each creator and day, from all pages that the store has taken."""
    return dashboard.follower_history(quality.filter_invalid_profiles(_store(spark, sf).profile_log()))


@query
def quarantine_inputs(spark, sf):
    """The reasons that lie outside the document: bytes, path, markup; and unloadable videos."""
    number = F.col("event_id")
    folder = F.concat(F.lit("profiles/user"), F.col("user_id"), F.lit("/"))
    kind = number % 5
    document = F.concat(
        F.lit(f'<script id="{SCRIPT_ID}">{{"__DEFAULT_SCOPE__":{{"webapp.user-detail":'
              '{"userInfo":{"user":{"uniqueId":"ann"},"stats":{}},"posts":[{"id":"1","createTime":1,'
              '"video":{},"stats":{"playCount":'),
        F.when(kind == 3, '"x"').otherwise("1e3"),
        F.lit("}}]}}}</script>"),
    )
    pages = fx.table(spark, sf, "events").select(
        F.concat(F.when(kind == 1, "").otherwise(folder), number, F.lit(".html")).alias("path"),
        F.when(kind == 0, F.lit(None)).when(kind == 2, "<p><![foo[x").otherwise(document).alias("html"),
        F.col("ts").cast("timestamp").alias("time_created"),
    )
    return quality.quarantine(pages).select("path", "scope", "reason")


# --- dashboard ------------------------------------------------------------------------------


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return quality.filter_invalid_profiles(_store(spark, sf).profiles.current())


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    return _store(spark, sf).videos.current()


@query
def followers_per_creator(spark, sf):
    return dashboard.followers_per_creator(_profiles(spark, sf))


@query
def total_followers(spark, sf):
    return dashboard.total_followers(_profiles(spark, sf))


@query
def verified_share(spark, sf):
    return dashboard.verified_share(_profiles(spark, sf))


@query
def followers_vs_likes(spark, sf):
    return dashboard.followers_vs_likes(_profiles(spark, sf))


@query
def followers_likes_correlation(spark, sf):
    return dashboard.followers_likes_correlation(_profiles(spark, sf))


@query
def trend_by_day(spark, sf):
    return dashboard.trend_by_day(_videos(spark, sf))


@query
def follower_history(spark, sf):
    return dashboard.follower_history(fx.scrapes(spark, sf))


@query
def engagement_video(spark, sf):
    return dashboard.engagement_video(_videos(spark, sf))


@query
def engagement_creator(spark, sf):
    return dashboard.engagement_creator(_store(spark, sf).attributed_videos())


@query
def creator_video_rollup(spark, sf):
    return dashboard.creator_video_rollup(_store(spark, sf).attributed_videos(), _profiles(spark, sf))


@query
def top_videos(spark, sf):
    return dashboard.top_videos(_videos(spark, sf))
