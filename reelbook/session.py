"""Session settings the library relies on, and where it may put working data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Runtime SQL settings. All of them may be set on a running session.
SETTINGS = {
    # Wall-clock text (landing names, ISO create times) is UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Pages are large rows and their nodes larger still: bound an Arrow batch by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
    # Latest-state streams keep one row per key: on local disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Files are listed by some tasks, not by one for each of up to 10,000 paths: a task's own
    # result and start cost more than the status of a file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # A stream writes its list of all files taken so far anew only now and then, not every ten batches.
    "spark.sql.streaming.fileSource.log.compactInterval": "100",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to ``spark`` and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory path for tables written between two steps.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``.
    Only a local session that has no such setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reelbook-")
    return f"{root.rstrip('/')}/reelbook/{purpose}-{uuid.uuid4().hex}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system has it, if Spark finds it on local disks; else None."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    local = system.getUri().getScheme() == "file"
    return system.makeQualified(target).toUri().getPath() if local else None


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files below ``path``; no rows if nothing has been written there yet."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


class Store:
    """Names and small files of a folder, in whatever file system Spark reads it from."""

    def __init__(self, spark: SparkSession, root: str):
        self._context, self.root = spark.sparkContext, root.rstrip("/")

    def _at(self, name: str):
        target = self._context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if self.root else name)
        return target.getFileSystem(self._context._jsc.hadoopConfiguration()), target

    def names(self, name: str) -> list[str]:
        """What lies directly in a folder; nothing if it is not there."""
        system, target = self._at(name)
        return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []

    def exists(self, name: str) -> bool:
        system, target = self._at(name)
        return system.exists(target)

    def read(self, name: str) -> str:
        """Content of a small file; empty if it is not there."""
        system, target = self._at(name)
        if not system.exists(target):
            return ""
        stream = system.open(target)
        try:
            return self._context._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Put a small file in its place at once: a reader sees all of it or none."""
        system, target = self._at(name)
        draft = self._at(f"{name}.{uuid.uuid4().hex}.draft")[1]
        stream = system.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if system.exists(target):
            system.delete(target, False)
        system.rename(draft, target)

    def claim(self, name: str) -> bool:
        """Create an empty file; False if it was there, so that only one caller gets it."""
        system, target = self._at(name)
        system.mkdirs(target.getParent())
        return system.createNewFile(target)

    def remove(self, name: str) -> None:
        system, target = self._at(name)
        system.delete(target, True)
