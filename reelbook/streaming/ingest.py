"""From landed pages to the ``profiles`` and ``videos`` tables, in batches or as a stream."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelbook.operators import quality
from reelbook.operators.extract import extract_pages, profile_rows, video_rows
from reelbook.operators.history import FollowerHistory
from reelbook.operators.upsert import LatestTable, latest
from reelbook.schemas import PROFILE_KEY, PROFILE_SCHEMA, VIDEO_KEY, VIDEO_SCHEMA
from reelbook.session import Store, read_if_there
from reelbook.sources import landing, messages, processed
from reelbook.sources.landing import PAGE_SCHEMA

logger = logging.getLogger(__name__)


class CreatorStore:
    """Everything derived from pages, below one folder.

    ``extracted/batch_id=N`` holds the result of each batch of pages; the two
    tables, the quarantine and the profile history are all read from it, so a
    page is parsed once. ``N`` counts the batches of the whole store: any number of
    streams may feed it, at the same time or one after another.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        order: str = "arrival",
        json_root: str | None = None,
        database: str | None = None,
        history: bool = False,
    ):
        if database and order != "arrival":
            raise ValueError("catalog tables do not keep page times: they take order='arrival' only")
        self.spark, self.root, self.json_root = spark, root.rstrip("/"), json_root
        self.database = database
        self.history = FollowerHistory(spark, f"{self.root}/history") if history else None
        self.profiles = LatestTable(
            spark, f"{self.root}/profiles", PROFILE_SCHEMA, PROFILE_KEY, order
        )
        # the name on the page a video was seen on, for those whose URL names nobody
        seen_on = [T.StructField("username", T.StringType())]
        self.videos = LatestTable(
            spark, f"{self.root}/videos", VIDEO_SCHEMA, VIDEO_KEY, order, more=seen_on
        )
        self._numbers = Store(spark, f"{self.root}/numbers")
        self._extracted = extract_pages(spark.createDataFrame([], PAGE_SCHEMA)).schema

    def number(self, stream: str, batch_id: int) -> int:
        """The store's number of a stream's batch: a new one, or that given to it before."""
        known = self._numbers.read(f"of/{stream}-{batch_id}")
        if known:
            return int(known)
        # the last number is a hint from which to look on: no listing of all batches ever taken
        number = 1 + int(self._numbers.read("last") or -1)
        while not self._numbers.claim(f"taken/{number}"):
            number += 1
        self._numbers.write("last", str(number))
        self._numbers.write(f"of/{stream}-{batch_id}", str(number))
        return number

    def take(self, pages: DataFrame, batch_id: int, stream: str = "given") -> dict[str, int]:
        """Extract a batch of pages and put it into both tables. Safe to repeat.

        A batch is named by its stream and its number there. With ``json_root`` the
        records are also written as JSON lines, with ``database`` they are upserted into
        its catalog tables, with ``history`` the follower history is kept up to date, one
        batch after another. Returns counts of the batch.
        """
        number = self.number(stream, batch_id)
        path = f"{self.root}/extracted/batch_id={number}"
        extracted, counts = quality.observed(extract_pages(landing.spread(pages)))
        extracted.write.mode("overwrite").parquet(path)
        done = self.spark.read.schema(self._extracted).parquet(path)
        origin = done.withColumnsRenamed({"path": "page_path", "time_created": "page_time"})
        profiles = profile_rows(origin, "page_path", "page_time")
        named = origin.withColumn("username", F.nullif("profile.username", F.lit("N/A")))
        videos = video_rows(named, "page_path", "page_time", "username", position=True)
        _at_once(
            lambda: self.profiles.append(profiles.withColumn("position", F.lit(0)), number),
            lambda: self.videos.append(videos, number),
        )
        if self.database:
            order = ("page_time", "page_path", "position")
            located = profiles.withColumn("position", F.lit(0))
            processed.upsert_table(located, f"{self.database}.profiles", PROFILE_KEY, order)
            processed.upsert_table(videos, f"{self.database}.videos", VIDEO_KEY, order)
        if self.history:
            self.history.fold(quality.filter_invalid_profiles(profiles))
        if self.json_root:
            for name, rows in (("profiles", profile_rows(done)), ("videos", video_rows(done))):
                target = f"{self.json_root}/{name}/batch_id={number}"
                processed.write_json(rows, target, mode="overwrite")
        return counts.get

    def extracted(self) -> DataFrame:
        """Page rows of all batches; of a page landed more than once the last.

        Paths that occur twice are found from the paths alone; only their rows are compared.
        """
        schema = T.StructType([*self._extracted.fields, T.StructField("batch_id", T.LongType())])
        rows = read_if_there(self.spark, f"{self.root}/extracted", schema)
        twice = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").select("path")
        again = latest(rows.join(twice, "path", "left_semi"), "path", ["time_created", "batch_id"])
        return rows.join(twice, "path", "left_anti").unionByName(again)

    def attributed_videos(self) -> DataFrame:
        """The video table with the ``username`` of the page that each row was seen on."""
        return self.videos.current(*self.videos.columns, "username")

    def profile_log(self) -> DataFrame:
        """All extracted profiles, not only the latest."""
        return profile_rows(self.extracted())

    def quarantine(self) -> DataFrame:
        """Pages and videos left out so far."""
        return quality.quarantine_rows(self.extracted())

    def publish(self, share: float = 0) -> None:
        """Fold the batches so far into new snapshots of both tables, of a table only if they
        hold at least this ``share`` of its snapshot's rows."""
        _at_once(lambda: self.profiles.publish(share), lambda: self.videos.publish(share))

    def drop_folded(self) -> None:
        """Remove logs and old snapshots of both tables that the newest snapshots replace."""
        self.profiles.drop_folded()
        self.videos.drop_folded()


def _at_once(*steps: Callable[[], None]) -> None:
    """Run steps that do not need each other at the same time, so that one's last tasks and
    planning leave no cores idle. Stopping the stream stops their jobs too."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(step)) for step in steps]:
            done.result()


def _stream_id(batch: DataFrame) -> str:
    """Id of the stream that runs this batch: it lives in the checkpoint, so a restart keeps it
    and a new checkpoint has another."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_ingest(
    pages: DataFrame,
    store: CreatorStore,
    checkpoint: str,
    available_now: bool = True,
    publish_every: int | None = None,
    publish_share: float = 1,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Feed a stream of pages into a store, one batch per trigger.

    ``read`` turns a batch of another stream into pages, such as
    :func:`landing.named_objects` for arrival records.

    The stream's id and the batch number name what a batch writes, so a batch that
    is run again after a failure replaces what it wrote before, and streams do not
    get in each other's way. Every ``publish_every`` batches a table folds its log into
    a new snapshot if that holds at least ``publish_share`` of the last snapshot's rows:
    else a stream of many batches would rewrite its tables as often. What is not folded
    yet is merged when it is read; with a share of 0 all is folded each time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = store.take(read(batch) if read else batch, batch_id, _stream_id(batch))
        logger.info("batch %s: %s", batch_id, counts)
        if publish_every and (batch_id + 1) % publish_every == 0:
            store.publish(publish_share)

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def start_landing(
    triggers: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    landing_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Trigger messages to landed pages: decode, ``fetch``, append to the landing table.

    ``fetch`` maps a DataFrame with ``url`` to ``url, html, fetched_at``. Messages
    that cannot be decoded go to ``<landing_path>-rejected``. Folders are named by
    the stream's id and the batch, so several streams may land in one place.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = messages.decode(batch)
        rejected = decoded.filter(F.col("url").isNull()).select("data", "publish_time")
        name = f"batch={_stream_id(batch)}-{batch_id}"
        rejected.write.mode("overwrite").parquet(f"{landing_path}-rejected/{name}")
        fetched = fetch(decoded.filter(F.col("url").isNotNull()))
        landing.land(fetched).write.mode("overwrite").parquet(f"{landing_path}/{name}")

    writer = triggers.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def stream_latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Latest row per key as a streaming aggregation (``update`` mode), one state row per key."""
    return latest(rows, key, order)


def run_latest(rows: DataFrame, key: str, order: list[str], out: str, checkpoint: str) -> DataFrame:
    """Run :func:`stream_latest` over what is available and return the final state.

    Each trigger writes the keys it changed; the last version of a key is its state.
    """
    spark = rows.sparkSession
    changed = stream_latest(rows, key, order)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (
        changed.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    log = spark.read.schema(changed.schema.add("batch_id", "long")).parquet(out)
    return latest(log, key, ["batch_id"]).drop("batch_id")
