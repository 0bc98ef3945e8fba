"""Streams give what one batch gives."""

import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from pages import HEAD, detail, info, post, script, tile
from reelbook import CreatorStore, extract_pages, extract_profiles, latest, scratch_dir, start_ingest, start_landing
from reelbook.operators import dashboard
from reelbook.operators.history import FollowerHistory
from reelbook.operators.quality import extraction_counts, filter_invalid_profiles
from reelbook.plans import fixtures as fx
from reelbook.plans import queries
from reelbook.sources import landing, messagelog, messages, processed
from reelbook.streaming import audit, counts
from reelbook.streaming.ingest import run_latest


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    path = scratch_dir(spark, "pages")
    fx.pages(spark, SF_DIR).repartition(4).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def batch_store(spark, pages):
    store = CreatorStore(spark, scratch_dir(spark, "store"), order="event_time")
    store.take(landing.read_table(spark, pages), 0)
    return store


def test_stream_equals_batch(spark, pages, batch_store):
    store = CreatorStore(spark, scratch_dir(spark, "store"), order="event_time")
    checkpoint = scratch_dir(spark, "ckpt")
    stream = landing.stream_table(spark, pages, files_per_batch=1)
    start_ingest(stream, store, checkpoint, publish_every=3).awaitTermination()
    assert store.extracted().select("batch_id").distinct().count() == 4
    for name in ("profiles", "videos"):
        ours, theirs = getattr(store, name).current(), getattr(batch_store, name).current()
        assert rows(ours) == rows(theirs)
    store.publish()
    assert rows(store.videos.current()) == rows(batch_store.videos.current())
    assert rows(store.quarantine()) == rows(batch_store.quarantine())
    # nothing new: a restart from the checkpoint takes no batch
    start_ingest(stream, store, checkpoint).awaitTermination()
    assert store.extracted().count() == batch_store.extracted().count()


def test_stream_rewrites_its_tables_as_they_double(spark, pages, batch_store):
    """Snapshots of a stream of many batches hold some twice its rows, not as many times as it has batches."""
    folder = scratch_dir(spark, "feed")
    landing.read_table(spark, pages).repartition(8, "path").write.parquet(folder)
    store = CreatorStore(spark, scratch_dir(spark, "store"), order="event_time")
    stream = landing.stream_table(spark, folder, files_per_batch=1)
    start_ingest(stream, store, scratch_dir(spark, "ckpt"), publish_every=1).awaitTermination()
    assert store.extracted().select("batch_id").distinct().count() == 8
    for name in ("profiles", "videos"):
        table, theirs = getattr(store, name), rows(getattr(batch_store, name).current())
        assert rows(table.current()) == theirs  # with batches that are not folded yet
        written = sum(spark.read.parquet(f"{table.path}/snapshot/{v}").count() for v in table._store.names("snapshot"))
        assert 0 < written < 2.5 * len(theirs)
        table.publish()
        assert not table._newer(table._head()) and rows(table.current()) == theirs


def test_repeated_batch(spark, pages, batch_store):
    before = rows(batch_store.profiles.current())
    counts = batch_store.take(landing.read_table(spark, pages), 0)
    assert rows(batch_store.profiles.current()) == before
    left_out = batch_store.quarantine()
    assert counts["pages"] == landing.read_table(spark, pages).count()
    assert counts["profiles"] + counts["faults"] == counts["pages"]
    assert counts["faults"] == left_out.filter("scope = 'page'").count()
    assert counts["lost_posts"] == left_out.agg(F.sum("lost")).first()[0] > 0


def test_profile_log_keeps_every_page(spark, pages, batch_store):
    expected = extract_profiles(landing.read_table(spark, pages))
    assert rows(batch_store.profile_log()) == rows(expected)


def test_objects_as_a_stream(spark, tmp_path):
    pages = {
        "ann": HEAD + tile(),
        "bob": script(detail(userInfo=info(uniqueId="bob"), posts=[post("1")])),
        "eve": b"\xff<p>",
    }
    for name, html in pages.items():
        folder = tmp_path / "profiles" / name
        folder.mkdir(parents=True)
        data = html if isinstance(html, bytes) else html.encode()
        (folder / "20240101-000000.html").write_bytes(data)
        (folder / "notes.txt").write_text("not a page")
    store = CreatorStore(spark, scratch_dir(spark, "store"), json_root=str(tmp_path / "json"))
    stream = landing.stream_objects(spark, str(tmp_path), files_per_batch=1)
    start_ingest(stream, store, scratch_dir(spark, "ckpt")).awaitTermination()
    found = store.profiles.current().collect()
    assert sorted(row.username for row in found) == ["ann", "bob"]
    assert all(row.scrape_timestamp is not None for row in found)
    assert store.videos.current().count() == 2
    assert rows(processed.read_json(spark, f"{tmp_path}/json/videos", "videos").drop("batch_id")) == (
        rows(store.videos.current())
    )
    assert [q.reason for q in store.quarantine().collect()] == ["invalid_utf8"]
    scanned = landing.object_columns(landing.read_objects(spark, str(tmp_path)), str(tmp_path))
    assert sorted(row.name for row in scanned.collect()) == [
        f"profiles/{name}/20240101-000000.html" for name in pages
    ]


def test_messages_to_tables(spark, tmp_path):
    """Trigger messages -> landed pages -> tables, as two streams joined by the landing folder."""
    urls = ["https://h.example/@ann", "https://h.example/@bob"]
    payloads = [base64.b64encode(url.encode()).decode() for url in urls] + ["!!bad"]
    source = tmp_path / "messages"
    source.mkdir()
    lines = [json.dumps({"data": data, "publish_time": "2024-05-01T10:00:00Z"}) for data in payloads]
    (source / "one.json").write_text("\n".join(lines))
    web = spark.createDataFrame(
        [(url, script(detail(userInfo=info(uniqueId=url[-3:]), posts=[post("7")]))) for url in urls],
        "url string, html string",
    )

    def fetch(wanted):
        return wanted.join(web, "url").select("url", "html", F.col("publish_time").alias("fetched_at"))

    landed = scratch_dir(spark, "landed")
    start_landing(
        messages.stream_messages(spark, str(source)), fetch, landed, scratch_dir(spark, "ckpt")
    ).awaitTermination()
    assert spark.read.parquet(f"{landed}-rejected").select("data").first().data == "!!bad"
    store = CreatorStore(spark, scratch_dir(spark, "store"))
    start_ingest(
        landing.stream_table(spark, landed), store, scratch_dir(spark, "ckpt")
    ).awaitTermination()
    assert sorted(row.username for row in store.profiles.current().collect()) == ["ann", "bob"]
    paths = sorted(row.path for row in store.extracted().collect())
    assert paths[0] == "profiles/ann/20240501-100000.html"


def test_latest_state_as_a_stream(spark):
    log = fx.scrapes(spark, SF_DIR)
    source = scratch_dir(spark, "log")
    log.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    state = run_latest(
        stream, "username", ["arrival"], scratch_dir(spark, "out"), scratch_dir(spark, "ckpt")
    )
    assert rows(state) == rows(latest(log, "username", ["arrival"]))


@pytest.mark.parametrize("publish", [False, True])
def test_two_streams_feed_one_store(spark, publish):
    """Each has a checkpoint of its own, so both count their batches from 0."""
    store = CreatorStore(spark, scratch_dir(spark, "store"), json_root=scratch_dir(spark, "json"))
    for name in ("ann", "bob", "ann"):
        folder = scratch_dir(spark, "feed")
        html = script(detail(userInfo=info(uniqueId=name), posts=[post(f"{name}1")]))
        page = spark.createDataFrame([(f"profiles/{name}/t.html", html)], "path string, html string")
        page.selectExpr("*", "now() AS time_created").write.parquet(folder)
        checkpoint = scratch_dir(spark, "ckpt")
        stream = landing.stream_table(spark, folder)
        start_ingest(stream, store, checkpoint).awaitTermination()
        if publish:
            store.publish()
    assert sorted(r.username for r in store.profiles.current().collect()) == ["ann", "bob"]
    assert store.videos.current().count() == 2
    assert store.attributed_videos().select("username").distinct().count() == 2
    # ann's page was landed twice under one path: it counts once
    assert sorted(r.username for r in store.profile_log().collect()) == ["ann", "bob"]
    assert store.extracted().select("batch_id").distinct().count() == 2
    assert spark.read.json(f"{store.json_root}/profiles").count() == 3


def test_replay_after_publishing(spark):
    page = lambda name: spark.createDataFrame(
        [(f"profiles/{name}/t.html", script(detail(userInfo=info(uniqueId=name))))], "path string, html string"
    ).selectExpr("*", "now() AS time_created")
    store = CreatorStore(spark, scratch_dir(spark, "store"))
    store.take(page("ann"), 0, "one")
    store.take(page("bob"), 0, "two")
    store.publish()
    store.take(page("ann"), 0, "one")
    assert store.number("one", 0) == 0 and store.number("two", 0) == 1
    assert store.profiles.current().count() == 2 and store.extracted().count() == 2


def test_two_streams_land_in_one_folder(spark, tmp_path):
    landed = scratch_dir(spark, "landed")
    for name in ("ann", "bob"):
        source = tmp_path / name
        source.mkdir()
        data = base64.b64encode(f"https://h.example/@{name}".encode()).decode()
        (source / "m.json").write_text(json.dumps({"data": data, "publish_time": "2024-05-01T10:00:00Z"}))
        fetch = lambda wanted: wanted.selectExpr("url", "'x' AS html", "publish_time AS fetched_at")
        start_landing(
            messages.stream_messages(spark, str(source)), fetch, landed, scratch_dir(spark, "ckpt")
        ).awaitTermination()
    assert landing.read_table(spark, landed).count() == 2


def test_first_wins_would_show(spark):
    """Creators' pages differ and videos repeat, so that keeping the first row is not the same."""
    pages = extract_profiles(fx.pages(spark, SF_DIR)).filter("username <> 'N/A'")
    ends = pages.groupBy("username").agg(
        F.min_by("follower_count", "scrape_timestamp").alias("first"),
        F.max_by("follower_count", "scrape_timestamp").alias("last"),
    )
    assert ends.filter("first <> last").count() > 10
    assert landing.read_table(spark, fx.landed_path(spark, SF_DIR)).inputFiles().__len__() >= 4


# --- arrival records --------------------------------------------------------------------


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return f"file:{path}"


def record(folder, name, paths):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"path": path, "event_time": "2024-05-01T10:00:00Z"}) for path in paths]
    (folder / f"{name}.draft").write_text("\n".join(lines))
    (folder / f"{name}.draft").rename(folder / f"{name}.json")


def test_arrivals_fetch_only_named_objects(spark, tmp_path):
    html = lambda name: script(detail(userInfo=info(uniqueId=name), posts=[post(name)]))
    paths = {name: put(tmp_path / "objects", f"profiles/{name}/t.html", html(name)) for name in ("ann", "bob", "eve")}
    odd = put(tmp_path / "objects", "profiles/k=[1]{a}*/t?.html", html("odd"))
    records = tmp_path / "records"
    store = CreatorStore(spark, scratch_dir(spark, "store"))
    checkpoint, listed = scratch_dir(spark, "ckpt"), []

    def read(batch):
        pages = landing.named_objects(batch)
        listed.append(len(pages.inputFiles()))
        return pages

    def ingest():
        stream = landing.stream_arrivals(spark, str(records), files_per_batch=1)
        start_ingest(stream, store, checkpoint, read=read).awaitTermination()
        return sorted(row.username for row in store.profiles.current().collect())

    record(records, "one", [paths["ann"], paths["ann"]])
    assert ingest() == ["ann"]
    record(records, "two", [paths["bob"], odd])
    # eve's object is there, but nothing has named it
    assert ingest() == ["ann", "bob", "odd"]
    assert listed == [1, 2]
    assert store.extracted().where("time_created IS NULL").count() == 0


def test_objects_that_are_gone(spark, tmp_path):
    there = put(tmp_path / "objects", "profiles/ann/t.html", "<p>")
    arrivals = spark.createDataFrame([(there,), (f"{there}.gone",), (None,)], "path string")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.named_objects(arrivals)
    found = landing.named_objects(arrivals, str(tmp_path / "missing"))
    assert [row.html for row in found.collect()] == ["<p>"]
    assert [row.path for row in spark.read.json(str(tmp_path / "missing")).collect()] == [f"{there}.gone"]
    assert landing.named_objects(arrivals.where("false")).count() == 0


# --- a message log --------------------------------------------------------------------------


def test_message_log_reads_nothing_twice(spark, tmp_path, monkeypatch):
    log, out, checkpoint = tmp_path / "log", tmp_path / "out", tmp_path / "ckpt"
    log.mkdir()
    line = lambda i: json.dumps({"data": f"m{i}", "publish_time": "2024-05-01T10:00:00Z"}) + "\n"

    def run():
        stream = messagelog.stream_log(spark, str(log))
        writer = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.data or "") for r in spark.read.parquet(str(out)).collect())

    (log / "0.ndjson").write_text("".join(map(line, range(3))) + line(9)[:20])  # the last line is not whole
    (log / "1.ndjson").write_text("no json\n[1]\n" + line(4))
    (log / "notes.txt").write_text(line(7))
    assert run() == ["", "", "m0", "m1", "m2", "m4"]
    assert run() == ["", "", "m0", "m1", "m2", "m4"]
    with (log / "0.ndjson").open("a") as file:
        file.write(line(9)[20:] + line(10))
    (log / "2.ndjson").write_text(line(11))
    assert run() == ["", "", "m0", "m1", "m10", "m11", "m2", "m4", "m9"]
    places = [(r.partition, r.position) for r in spark.read.parquet(str(out)).collect()]
    assert len(set(places)) == len(places)


def test_stretches_of_a_log(tmp_path, monkeypatch):
    monkeypatch.setattr(messagelog, "TASK_BYTES", 100)
    monkeypatch.setattr(messagelog, "LOOK_BYTES", 7)
    lines = [b"x" * n + b"\n" for n in (10, 90, 5, 300, 20, 20, 0, 99, 100)]
    (tmp_path / "0.ndjson").write_bytes(b"".join(lines) + b"tail")
    reader = messagelog.LogReader(str(tmp_path))
    end = reader.latestOffset()
    assert end == {"0": sum(map(len, lines))}
    parts = reader.partitions({}, end)
    assert parts[0].start == 0 and parts[-1].stop == end["0"] and len(parts) > 1
    assert all(a.stop == b.start for a, b in zip(parts, parts[1:], strict=False))
    at = [place for part in parts for *_, place in reader.read(part)]
    assert at == [sum(map(len, lines[:i])) for i in range(len(lines))]
    assert reader.partitions(end, end) == []
    assert messagelog.LogReader(str(tmp_path / "none")).latestOffset() == {}


# --- audit and counts -------------------------------------------------------------------------


def test_overwrites_over_triggers(spark, tmp_path):
    log = [("ann", 1, 50), ("ann", 2, 40), ("bob", 3, 1), ("ann", 4, 45), ("ann", 5, 45), ("bob", 6, 0), (None, 7, 1), ("bob", 8, None)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (log[:3], log[3:]):
        given = spark.createDataFrame(part, "username string, arrival bigint, t bigint")
        given.selectExpr("username", "arrival", "timestamp_seconds(t) scrape_timestamp").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("username string, arrival bigint, scrape_timestamp timestamp")
    found = audit.overwrites(stream.option("maxFilesPerTrigger", 1).parquet(source))
    writer = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ckpt"))
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).selectExpr("username", "arrival", "unix_seconds(scrape_timestamp) t", "replaced_arrival r")
    assert rows(got) == [("ann", 2, 40, 1), ("bob", 6, 0, 3)]


def test_counts_of_every_batch(spark, pages, tmp_path):
    listener = counts.BatchCounts(spark, str(tmp_path / "counts"))
    assert listener.table().count() == 0
    spark.streams.addListener(listener)
    stream = landing.stream_table(spark, pages, files_per_batch=1)
    writer = counts.observed(extract_pages(stream)).writeStream.format("noop")
    writer.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    table = listener.table()
    spark.streams.removeListener(listener)
    rows = [r.asDict() for r in table.collect()]
    assert len(rows) == 4 and len({r["batch_id"] for r in rows}) == 4
    total = {name: sum(r[name] for r in rows) for name in ("pages", "faults", "profiles", "videos", "lost_posts")}
    given = landing.read_table(spark, pages)
    assert total["pages"] == given.count() and total["profiles"] + total["faults"] == total["pages"]
    assert total["videos"] == extraction_counts(given).agg(F.sum("videos")).first()[0]


# --- follower history ---------------------------------------------------------------------


def observations(spark, items):
    data = [(f"profiles/{who}/{page}", who, t, n) for who, page, t, n in items]
    rows = spark.createDataFrame(data, "page_path string, username string, t long, follower_count bigint")
    return rows.withColumn("scrape_timestamp", F.timestamp_seconds("t"))


def test_follower_history_in_any_batching(spark):
    day, rng = 86_400, random.Random(3)
    items = [(rng.choice("aaaab"), i, rng.randrange(6 * day), rng.randrange(100)) for i in range(120)]
    want = rows(dashboard.follower_history(observations(spark, items)).select("username", "day", "follower_count", "scrapes"))
    for cuts in ([120], [10, 70, 120], [40, 80, 120]):
        history, start = FollowerHistory(spark, scratch_dir(spark, "history")), 0
        for end in cuts:
            history.fold(observations(spark, items[start:end]))
            start = end
        history.fold(observations(spark, items[:20]))  # again
        assert rows(history.current()) == want


def test_follower_history_writes_touched_days_only(spark):
    day = 86_400
    history = FollowerHistory(spark, scratch_dir(spark, "history"))
    assert history.current().count() == 0 and history.fold(observations(spark, []).where("false")) == []
    assert history.fold(observations(spark, [("ann", i, i * day, i) for i in range(5)])) == [
        f"1970-01-0{i + 1}" for i in range(5)
    ]
    before = set(spark.read.parquet(f"{history.path}/days").inputFiles())
    # the same page again, later that day, and a page without a creator
    batch = observations(spark, [("ann", 2, 2 * day + 5, 50)]).unionByName(
        observations(spark, [("x", 1, 0, 1)]).withColumn("username", F.lit(None).cast("string"))
    )
    assert history.fold(batch) == ["1970-01-03"]
    after = set(spark.read.parquet(f"{history.path}/days").inputFiles())
    assert len(after - before) == 1 and len(before - after) == 1
    found = {str(r.day): (r.follower_count, r.scrapes) for r in history.current().collect()}
    assert found["1970-01-03"] == (50, 1) and found["1970-01-02"] == (1, 1)


def test_store_keeps_history_and_catalog(spark, pages):
    processed.create_tables(spark, "fed", scratch_dir(spark, "catalog"), buckets=4)
    store = CreatorStore(spark, scratch_dir(spark, "store"), history=True, database="fed")
    start_ingest(landing.stream_table(spark, pages, files_per_batch=2), store, scratch_dir(spark, "ckpt")).awaitTermination()
    log = filter_invalid_profiles(store.profile_log())
    wanted = dashboard.follower_history(log).select("username", "day", "follower_count", "scrapes")
    assert rows(store.history.current()) == rows(wanted)
    for name in ("profiles", "videos"):
        assert rows(spark.table(f"fed.{name}").drop("bucket")) == rows(getattr(store, name).current())
    with pytest.raises(ValueError):
        CreatorStore(spark, "/nowhere", order="event_time", database="fed")
    spark.sql("DROP DATABASE fed CASCADE")


# --- large inputs ---------------------------------------------------------------------------


def test_batch_of_one_file_is_dealt_over_cores(spark, tmp_path):
    html = script(detail(userInfo=info(), posts=[post("1")]))
    rows = [(f"profiles/p{i}/t.html", html) for i in range(400)]
    pages = spark.createDataFrame(rows, "path string, html string").selectExpr("*", "timestamp'2024-05-01 10:00:00' AS time_created")
    pages.coalesce(1).write.parquet(str(tmp_path / "feed"))
    store = CreatorStore(spark, str(tmp_path / "store"))
    start_ingest(landing.stream_table(spark, str(tmp_path / "feed")), store, scratch_dir(spark, "ckpt")).awaitTermination()
    assert len(list((tmp_path / "store" / "extracted" / "batch_id=0").glob("*.parquet"))) > 1
    assert store.extracted().count() == 400


def test_names_are_looked_up_by_few_tasks(spark, tmp_path):
    paths = [put(tmp_path / "objects", f"profiles/p{i}/t.html", "<p>") for i in range(120)]
    arrivals = spark.createDataFrame([(path,) for path in paths], "path string").coalesce(1).persist()
    arrivals.count()
    context = spark.sparkContext
    context.setJobGroup("names", "names")
    found = landing.named_objects(arrivals)
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("names") for s in tracker.getJobInfo(job).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages) < 120
    assert found.count() == 120
    arrivals.unpersist()


def test_chain_reads_the_web_once(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(queries, "scratch_dir", lambda s, purpose: asked.append(purpose) or scratch_dir(s, purpose))
    queries.QUERIES["stream_chain"](spark, SF_DIR).count()
    assert "web" in asked
