"""One key with a third of all rows: results stay whole and no group grows with it."""

import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare
from conftest import SF_DIR
from reelbook.plans import fixtures as fx

HOT = 12  # a creator whose pages hold their posts in the usual place


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The small tables, with a third of the orders, line items and events on one key."""
    folder = tmp_path_factory.mktemp("skewed")
    changes = {
        "orders": f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN {HOT} ELSE o_custkey END AS o_custkey)",
        "events": f"SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN {HOT} ELSE user_id END AS user_id)",
        "lineitem": f"SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN {HOT} ELSE l_partkey END AS l_partkey,"
                    " CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey)",
    }
    for name in ("customer", "conversations", "pages"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", folder)
    for name, select in changes.items():
        duckdb.sql(f"COPY ({select} FROM '{SF_DIR}/{name}.parquet') TO '{folder}/{name}.parquet'")
    return str(folder)


def test_pages_of_a_hot_creator_stay_small(spark, skewed):
    sizes = fx.page_posts(spark, skewed).select("c_custkey", F.size("posts").alias("posts"))
    hot = sizes.filter(F.col("c_custkey") == HOT).agg(F.count("*"), F.max("posts")).first()
    assert hot[0] >= 40 and hot[1] <= 3 * fx.POSTS_PER_PAGE


@pytest.mark.parametrize(
    "name",
    [
        "page_profiles",
        "page_videos",
        "video_source_chain",
        "stream_profiles",
        "stream_videos",
        "engagement_creator",
        "creator_video_rollup",
        "latest_profile",
        "merge_profiles",
        "merge_videos",
        "landing_dedupe",
        "follower_history",
    ],
)
def test_hot_key(spark, skewed, name):
    assert compare(spark, skewed, name, entry.queries()[name], entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("html_")])
def test_markup_is_read_once(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_scattered_numbers_do_not_overflow(spark):
    numbers = spark.range(10**12, 10**12 + 1000).select(fx._scatter(F.col("id")).alias("n"))
    assert numbers.distinct().count() == 1000
    assert numbers.filter(f"n < 0 OR n >= {fx.ARRIVALS}").count() == 0


def test_shaped_documents_are_made_in_several_tasks(spark):
    assert entry.queries()["json_shape_guard"](spark, SF_DIR).rdd.getNumPartitions() > 1


@pytest.mark.parametrize("name", ["fallback_profile", "json_shape_guard"])
def test_videos_that_nobody_reads_are_not_built(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "thumbnail" not in plan
    assert plan.count("ArrowEvalPython") == 1
