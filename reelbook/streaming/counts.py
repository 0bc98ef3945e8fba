"""Counts of every batch as a table, from what streams observe."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from reelbook.session import Store, read_if_there

#: Name under which a stream observes its batches.
EXTRACTION = "extraction"
COUNTS = "stream string, batch_id bigint, pages bigint, faults bigint, profiles bigint, videos bigint, lost_posts bigint"
_NAMES = ("pages", "faults", "profiles", "videos", "lost_posts")


def observed(extracted: DataFrame) -> DataFrame:
    """Extracted pages, counted under the name :data:`EXTRACTION` while they pass."""
    return extracted.observe(
        EXTRACTION,
        F.count("*").alias("pages"),
        F.count("fault").alias("faults"),
        F.count("profile").alias("profiles"),
        F.coalesce(F.sum(F.size("videos")), F.lit(0)).alias("videos"),
        F.coalesce(F.sum("lost_posts"), F.lit(0)).alias("lost_posts"),
    )


class BatchCounts(StreamingQueryListener):
    """Writes the counts of each batch as one small file, named by stream and batch.

    A batch that is run again replaces its file. Use as ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._spark, self._store, self._lock = spark, Store(spark, self.path), threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(EXTRACTION)
        if found is None:
            return
        row = {"stream": str(progress.id), "batch_id": progress.batchId} | {n: found[n] for n in _NAMES}
        with self._lock:
            self._store.write(f"{progress.id}-{progress.batchId}.json", json.dumps(row))

    def table(self) -> DataFrame:
        """One row for each batch so far: ``stream, batch_id`` and its counts.

        Progress reaches listeners a little after the batch; what is on its way is awaited.
        """
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        schema = self._spark.createDataFrame([], COUNTS).schema
        if not self._store.names(""):
            return read_if_there(self._spark, self.path, schema)
        return self._spark.read.schema(schema).option("pathGlobFilter", "*.json").json(self.path)
