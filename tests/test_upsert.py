"""Latest state per key, merges, and the table that takes batches."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelbook import LatestTable, latest, merge_upsert, scratch_dir
from reelbook.operators.quality import filter_invalid_profiles, reject_null_keys
from reelbook.sources import landing, processed

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("a", T.LongType()),
        T.StructField("b", T.StringType()),
    ]
)


@pytest.fixture
def frame(spark):
    return lambda rows, schema="k string, a bigint, b string": spark.createDataFrame(rows, schema)


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_merge_updates_inserts_and_keeps(frame):
    target = frame([("x", 1, "old"), ("y", 2, "old")])
    source = frame([("y", None, None), ("z", 3, "new"), (None, 4, "no key")])
    merged = merge_upsert(target, source, "k")
    # matched rows take NULLs too, others stay, nothing is deleted
    assert {row.k: (row.a, row.b) for row in merged.collect()} == {
        "x": (1, "old"), "y": (None, None), "z": (3, "new"),
    }
    assert merged.columns == target.columns


def test_merge_twice_changes_nothing(frame):
    target, source = frame([("x", 1, "t")]), frame([("x", 2, "s"), ("y", 3, "s")])
    once = merge_upsert(target, source, "k")
    assert rows(merge_upsert(once, source, "k")) == rows(once)


def test_repeated_keys_in_a_source(frame):
    source = frame([("x", 1, "first"), ("x", 2, "last"), ("x", 2, "also")])
    assert rows(latest(source, "k", ["a"])) == [("x", 2, "last")]
    assert rows(merge_upsert(frame([]), source, "k", ["a"])) == [("x", 2, "last")]


def test_latest_against_brute_force(frame):
    rng = random.Random(7)
    log = [(rng.choice("xxxxxyz"), n, str(rng.random())) for n in range(500)]
    rng.shuffle(log)
    best = {}
    for key, order, value in log:
        best[key] = max(best.get(key, (-1, "")), (order, value))
    assert rows(latest(frame(log), "k", ["a"])) == sorted((k, *v) for k, v in best.items())


def test_merge_shares_its_shuffle(spark, frame):
    """One exchange per side: the deduplication of the source feeds the join."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(100).selectExpr("cast(id as string) k", "id a", "'t' b")
        source = spark.range(300).selectExpr("cast(id % 50 as string) k", "id a", "'s' b")
        plan = merge_upsert(target, source, "k", ["a"])._jdf.queryExecution().executedPlan()
        assert plan.toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def scrape(frame, items):
    """Items ``(key, value, page time in seconds)``."""
    data = [(k, a, f"v{a}", t, f"p{a}", 0) for k, a, t in items]
    raw = frame(data, "k string, a bigint, b string, t bigint, page_path string, position int")
    return raw.withColumn("page_time", F.timestamp_seconds("t"))


LOG = [("x", 1, 10), ("y", 2, 20), ("x", 3, 5), ("z", 4, 40), ("x", 5, 30), ("y", 6, 20)]


@pytest.mark.parametrize("cuts", [[6], [2, 6], [1, 2, 3, 4, 5, 6]])
@pytest.mark.parametrize("publish", [False, True])
def test_event_time_table_does_not_depend_on_batches(spark, frame, cuts, publish):
    table = LatestTable(spark, scratch_dir(spark, "t"), SCHEMA, "k", "event_time")
    start = 0
    for batch_id, end in enumerate(cuts):
        table.append(scrape(frame, LOG[start:end]), batch_id)
        if publish:
            table.publish()
        start = end
    assert rows(table.current()) == [("x", 5, "v5"), ("y", 6, "v6"), ("z", 4, "v4")]


def test_arrival_table_lets_older_scrapes_win(spark, frame):
    table = LatestTable(spark, scratch_dir(spark, "t"), SCHEMA, "k")
    assert rows(table.current()) == []
    table.append(scrape(frame, [("x", 1, 50)]), 0)
    table.publish()
    table.append(scrape(frame, [("x", 2, 10)]), 1)
    assert rows(table.current()) == [("x", 2, "v2")]
    # a repeated batch replaces itself
    table.append(scrape(frame, [("x", 3, 10), (None, 9, 9)]), 1)
    assert rows(table.current()) == [("x", 3, "v3")]


def test_table_reads_only_wanted_columns(spark, frame):
    table = LatestTable(spark, scratch_dir(spark, "t"), SCHEMA, "k")
    table.append(scrape(frame, LOG), 0)
    expected = [("x", 5), ("y", 6), ("z", 4)]
    for published in (False, True):
        if published:
            table.publish()
        found = table.current("k", "a")
        assert rows(found) == expected
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "b#" not in plan
    assert "Exchange" not in plan


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_publish_rewrites_touched_buckets_only(spark, frame):
    path = scratch_dir(spark, "t")
    table = LatestTable(spark, path, SCHEMA, "k", buckets=8)
    table.append(scrape(frame, [(f"k{i}", i, i) for i in range(100)]), 0)
    table.publish()
    before = files(f"{path}/snapshot")
    assert len({f.split("bucket=")[1].split("/")[0] for f in before}) == 8
    table.publish()
    assert files(f"{path}/snapshot") == before and os.listdir(f"{path}/published") != []
    table.append(scrape(frame, [("k1", 500, 1)]), 1)
    table.publish()
    new = files(f"{path}/snapshot") - before
    assert len({f.split("bucket=")[1].split("/")[0] for f in new}) == 1
    assert table.current().count() == 100
    assert table.current().filter("k = 'k1'").first().a == 500
    # what the snapshot holds can go; a replay of it changes nothing
    table.drop_folded()
    assert not files(f"{path}/log")
    table.append(scrape(frame, [("k1", 500, 1)]), 1)
    assert table.current().count() == 100 and table.current().filter("k = 'k1'").first().a == 500


def test_batches_that_arrive_late_still_count(spark, frame):
    """Number 1 is still being written when 2 is published."""
    table = LatestTable(spark, scratch_dir(spark, "t"), SCHEMA, "k")
    table.append(scrape(frame, [("x", 1, 1)]), 0)
    table.append(scrape(frame, [("x", 3, 3), ("y", 3, 3)]), 2)
    table.publish()
    table.append(scrape(frame, [("x", 2, 2), ("z", 2, 2)]), 1)
    expected = [("x", 3, "v3"), ("y", 3, "v3"), ("z", 2, "v2")]
    assert rows(table.current()) == expected
    table.publish()
    table.drop_folded()
    assert rows(table.current()) == expected


def test_table_with_unknown_order(spark):
    with pytest.raises(ValueError):
        LatestTable(spark, "/nowhere", SCHEMA, "k", "other")


def test_invalid_and_null_keys(frame):
    profiles = frame([("ann", 1), ("", 2), ("N/A", 3), (None, 4)], "username string, n bigint")
    assert rows(filter_invalid_profiles(profiles)) == [("ann", 1)]
    kept, refused = reject_null_keys(profiles, "username")
    assert (kept.count(), refused.count()) == (3, 1)


def test_last_landed(spark):
    landed = [("a", "1", 10), ("a", "2", 20), ("b", "3", 5), ("c", "4", 7), ("c", "5", 7), ("c", "5", 7),
              ("c", "9", 6), ("d", "6", None)]
    pages = spark.createDataFrame(landed, "path string, html string, t bigint").selectExpr(
        "path", "html", "timestamp_seconds(t) time_created"
    )
    found = landing.last_landed(pages).select("path", "html")
    assert rows(found) == [("a", "2"), ("b", "3"), ("c", "5"), ("d", "6")]


def test_last_landed_of_files(spark):
    landed = [("a", "1", 10), ("a", "2", 20), ("b", "3", 5), ("c", "4", 7), ("c", "5", 7), ("c", "9", 6), ("d", "6", None)]
    path = scratch_dir(spark, "landed")
    spark.createDataFrame(landed, "path string, html string, t bigint").selectExpr(
        "path", "html", "timestamp_seconds(t) time_created"
    ).repartition(3).write.parquet(path)
    found = landing.last_landed(landing.read_table(spark, path))
    got = rows(found.select("path", "html"))
    assert [r for r in got if r[0] != "c"] == [("a", "2"), ("b", "3"), ("d", "6")]
    assert [r[1] in "45" for r in got if r[0] == "c"] == [True]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "parquet" in line and "Relation" in line]
    executed = found._jdf.queryExecution().sparkPlan().toString()
    assert executed.count("html:string") == 1 and len(scans) == 2


def test_json_read_is_strict(spark, tmp_path):
    good = '{"url":"u","views":1,"description":null}\n'
    for name, text in (("good", good), ("bad", good + '{"url":"u","views":"x"}\n'),
                       ("null", good + '{"url":null}\n')):
        (tmp_path / name).write_text(text)
    read = lambda name: processed.read_json(spark, str(tmp_path / name), "videos")
    assert read("good").first().views == 1
    for name in ("bad", "null"):
        with pytest.raises(Exception):
            read(name).collect()


def test_catalog_tables(spark):
    processed.create_tables(spark, "creators")
    processed.create_tables(spark, "creators")
    videos = spark.table("creators.videos")
    assert videos.columns[:2] == ["url", "views"] and videos.isEmpty()
    row = spark.range(1).selectExpr(
        "'u' url", "1L views", "'t' thumbnail", "'d' description", "'N/A' create_time",
        "0L like_count", "0L comment_count", "0L share_count",
    )
    processed.publish_table(row, "creators.videos")
    processed.publish_table(row, "creators.videos")
    assert spark.table("creators.videos").count() == 1
    spark.sql("DROP DATABASE creators CASCADE")


def test_columns_go_by_name(spark):
    processed.create_tables(spark, "named")
    row = spark.range(1).selectExpr(
        "'d' description", "'t' thumbnail", "'u' url", "1L views", "'N/A' create_time",
        "0L like_count", "0L comment_count", "0L share_count", "'more' other",
    )
    processed.publish_table(row, "named.videos")
    found = spark.table("named.videos").first()
    assert (found.description, found.thumbnail) == ("d", "t")
    spark.sql("DROP DATABASE named CASCADE")


def videos_of(frame, items):
    data = [(f"u{k}", v, None if v % 2 else f"d{v}", v) for k, v in items]
    return frame(data, "url string, views bigint, description string, n bigint").selectExpr(
        "*", "'t' thumbnail", "'N/A' create_time", "0L like_count", "0L comment_count", "0L share_count"
    )


def test_catalog_upsert(spark, frame):
    """The buckets of a table are rewritten where a batch touches them, and nowhere else."""
    processed.create_tables(spark, "upserts", scratch_dir(spark, "catalog"), buckets=64)
    table = "upserts.videos"
    assert processed.upsert_table(videos_of(frame, [(i, 2 * i) for i in range(2000)]), table, "url") == "buckets"
    assert spark.table(table).count() == 2000
    before = set(spark.table(table).inputFiles())
    assert len(before) == 64
    change = [(5, 101), (5, 99), (7, 102), (9000, 3)]
    processed.upsert_table(videos_of(frame, change), table, "url", ["n"])
    after = set(spark.table(table).inputFiles())
    assert 1 <= len(after - before) <= 3
    found = {r.url: (r.views, r.description) for r in spark.table(table).collect()}
    assert len(found) == 2001
    assert found["u5"] == (101, None) and found["u7"] == (102, "d102") and found["u9000"] == (3, None)
    assert found["u8"] == (16, "d16")
    # again, and with nothing: the same rows
    processed.upsert_table(videos_of(frame, change), table, "url", ["n"])
    processed.upsert_table(videos_of(frame, change).where("false"), table, "url", ["n"])
    assert {r.url: (r.views, r.description) for r in spark.table(table).collect()} == found
    spark.sql("DROP DATABASE upserts CASCADE")


def test_catalog_without_merge_is_refused(spark, frame):
    processed.create_tables(spark, "plain")
    with pytest.raises(processed.MergeUnsupported, match="plain.videos"):
        processed.upsert_table(videos_of(frame, [(1, 1)]), "plain.videos", "url")
    assert spark.table("plain.videos").isEmpty()
    spark.sql("DROP DATABASE plain CASCADE")


def test_merge_statement(spark):
    """No catalog here has row-level MERGE: its plan is looked at instead."""
    sql = processed.merge_statement("c.d.videos", "url", ["url", "views"]).format(source="s")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert plan.startswith("'MergeIntoTable ('t.url = 's.url)")
    assert "updateaction(None, assignment('t.views, 's.views)" in plan
    assert "insertaction(None, assignment('url, 's.url), assignment('views, 's.views))" in plan


def test_few_keys_rewrite_few_buckets(spark, frame):
    """The number of buckets follows the table, so a batch of 150 keys leaves most of it alone."""
    path = scratch_dir(spark, "t")
    table = LatestTable(spark, path, SCHEMA, "k", bucket_rows=20)
    table.append(scrape(frame, [(f"k{i}", i, i) for i in range(10)]), 0)
    table.publish()
    assert len(files(f"{path}/snapshot")) == 1
    many = spark.range(5_000).selectExpr("concat('k', id) k", "id a", "'v' b", "timestamp_seconds(id) page_time",
                                         "'p' page_path", "0 position")
    table.append(many, 1)
    table.publish()
    table.drop_folded()
    before = files(f"{path}/snapshot")
    assert len(before) > 250
    table.append(scrape(frame, [(f"k{i}", -i, 10**6) for i in range(20)]), 2)
    table.publish()
    assert 0 < len(files(f"{path}/snapshot") - before) <= 20 < len(before) / 10
    assert table.current().count() == 5_000 and table.current().where("a < 0").count() == 19
    table.drop_folded()
    assert len(files(f"{path}/snapshot")) == len(before) and os.listdir(f"{path}/log") == []
    # 150 keys of a table of 2^31 rows at the standard size of a bucket
    size = LatestTable(spark, path, SCHEMA, "k")._wanted(1 << 31)
    assert size >= 4096 and len(table._touched(many.limit(150), size)) <= 150 < size / 10


def test_upsert_writes_rows_and_table_only(spark, frame, monkeypatch, tmp_path):
    """The merged buckets go into the table at once, without a table in between."""
    database = "one_writing"
    processed.create_tables(spark, database, str(tmp_path / "db"), buckets=4)
    for add, work in ((0, "a"), (20, "b")):
        monkeypatch.setattr(processed, "scratch_dir", lambda s, purpose, work=work: str(tmp_path / work))
        rows = videos_of(frame, [(i + add, i + 100 * add) for i in range(40)])
        processed.upsert_table(rows, f"{database}.videos", "url")
        assert os.listdir(tmp_path / work) == ["rows"]
    assert spark.table(f"{database}.videos").count() == 60
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_rows_are_sorted_by_a_hash_of_the_key(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "concat('https://host.example/@user/video/', id % 7) AS url", "id % 5 AS time", "id AS views"
    ).union(spark.sql("SELECT NULL, 9L, 9L"))
    found = latest(rows, "url", ["time"], hashed=True)
    assert sorted(found.collect()) == sorted(latest(rows, "url", ["time"]).collect())
    assert found.columns == rows.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not plan.split("Sort [", 1)[1].startswith("url")


def test_publish_shuffles_and_sorts_once(spark, frame, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), SCHEMA, "k", bucket_rows=20)
    origin = ["timestamp'2024-01-01' AS page_time", "'p' AS page_path", "0 AS position"]
    best = {}
    for batch, count in enumerate((100, 60, 150)):
        rows_ = [(f"k{n * (batch + 1) % 170}", batch, str(n)) for n in range(count)]
        last = {row[0]: row for row in rows_}  # one row per key and batch
        best |= last
        table.append(frame([*last.values()]).selectExpr("*", *origin), batch)
        if batch < 2:
            table.publish()
    head, log = table._head(), table._log([2])
    both = table._both(head, log, list(head["places"]), table._schema.fieldNames())
    plan = table._dealt(both, head["size"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("+- Sort [") == 1
    table.publish()
    assert rows(table.current()) == sorted(best.values())
    assert sum(table._head()["rows"].values()) == len(best)
