"""Follower history kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.operators.dashboard import follower_history
from reelbook.operators.upsert import latest
from reelbook.session import read_if_there, scratch_dir

_PAGES = "page_path string, username string, scrape_timestamp timestamp, follower_count bigint, day date"
_DAYS = "username string, follower_count bigint, scrapes bigint, day date"


class FollowerHistory:
    """Last follower count and number of pages of each creator and day, at ``path``.

    ``pages/day=D`` has one narrow row for each page scraped that day, ``days/day=D`` one
    for each creator. Folding a batch reads and rewrites only the days that the batch
    touches (dynamic partition overwrite); a page counts once a day, its last landing
    deciding, so a batch that is folded again, or cut otherwise, changes nothing. A page
    landed again on another day counts on both. Rows without a creator, a path or a time
    are left out. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def fold(self, profiles: DataFrame) -> list[str]:
        """Take extracted profiles with their ``page_path``; returns the days written."""
        scraped = F.col("scrape_timestamp")
        rows = profiles.where(F.col("username").isNotNull() & scraped.isNotNull() & F.col("page_path").isNotNull())
        rows = rows.select("page_path", "username", "scrape_timestamp", "follower_count", scraped.cast("date").alias("day"))
        work = scratch_dir(self.spark, "history")
        rows.write.parquet(f"{work}/batch")
        rows = self.spark.read.schema(_PAGES).parquet(f"{work}/batch")
        days = [row.day for row in rows.select("day").distinct().collect()]  # days of one batch
        if not days:
            return []
        old = read_if_there(self.spark, f"{self.path}/pages", rows.schema).where(F.col("day").isin(days))
        both = old.unionByName(rows).withColumn("page", F.struct("day", "page_path"))
        pages = latest(both, "page", ["scrape_timestamp", "follower_count", "username"], hashed=True)
        pages = pages.drop("page")
        pages.write.parquet(f"{work}/pages")
        pages = self.spark.read.schema(_PAGES).parquet(f"{work}/pages")
        self._replace(pages, "pages")
        self._replace(follower_history(pages), "days")
        return sorted(str(day) for day in days)

    def _replace(self, rows: DataFrame, name: str) -> None:
        # large days are spread over several tasks, small ones share one
        writer = rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{name}")

    def current(self) -> DataFrame:
        """``username, day, follower_count, scrapes``: a plain scan."""
        schema = self.spark.createDataFrame([], _DAYS).schema
        return read_if_there(self.spark, f"{self.path}/days", schema).select("username", "day", "follower_count", "scrapes")
