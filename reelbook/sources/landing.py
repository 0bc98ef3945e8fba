"""Raw pages: one object per page, or a landing table of many pages per file."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.functions import text as tx
from reelbook.operators.upsert import latest
from reelbook.session import Store

ARRIVAL_SCHEMA = "path string, event_time timestamp"
PAGE_SCHEMA = "path string, html string, time_created timestamp"
#: Tasks that read a folder of objects: enough to keep all cores busy to the end.
TASKS_PER_CORE = 16
_OBJECT_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _as_pages(objects: DataFrame) -> DataFrame:
    """Objects as pages; ``html`` is NULL where the bytes are not UTF-8."""
    return objects.select(
        "path",
        F.try_validate_utf8(F.col("content").cast("string")).alias("html"),
        F.col("modificationTime").alias("time_created"),
    )


def _packed(objects: DataFrame) -> DataFrame:
    """The same objects in some tasks for each core. Spark counts each object as 4 MB, so a task
    gets some thirty small ones, and its own start and result cost more than reading them."""
    return objects.coalesce(TASKS_PER_CORE * objects.sparkSession.sparkContext.defaultParallelism)


def read_objects(spark: SparkSession, root: str, pattern: str = "*.html") -> DataFrame:
    """Pages from a folder with one object per page."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return _as_pages(_packed(found))


def stream_objects(
    spark: SparkSession, root: str, pattern: str = "*.html", files_per_batch: int = 10000
) -> DataFrame:
    """New objects of the folder as a stream of pages.

    Each trigger lists the whole folder. Where it holds very many objects, stream their
    arrival records (:func:`stream_arrivals`) or land pages in a table. A batch is read by
    one task for each core: what a sink writes for each task costs more than its objects.
    """
    found = (
        spark.readStream.format("binaryFile")
        .schema(_OBJECT_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    return _as_pages(found.coalesce(spark.sparkContext.defaultParallelism))


def stream_arrivals(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Arrival records (JSON lines of ``path, event_time``) as a stream: what a bucket
    notification says, one record for each object written."""
    return spark.readStream.schema(ARRIVAL_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path)


def named_objects(arrivals: DataFrame, missing_path: str | None = None) -> DataFrame:
    """Pages of the objects that a batch of arrival records names, each once.

    Only these objects are looked up; no folder is listed. The names of one batch pass
    the driver, which plans their files. Objects that are gone are written to
    ``missing_path`` as JSON lines if that is given, else they fail the read.
    """
    spark = arrivals.sparkSession
    paths = sorted(row.path for row in arrivals.select("path").distinct().collect() if row.path)

    def read(some: list[str]) -> DataFrame:
        if not some:
            return spark.createDataFrame([], PAGE_SCHEMA)
        exact = [re.sub(r"([\\*?{}\[\]])", r"\\\1", path) for path in some]  # names, not patterns
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        # all names in one call: a list would go over one by one, each waiting for its answer
        split = spark.sparkContext._jvm.org.apache.commons.lang3.StringUtils.split
        found = DataFrame(reader._jreader.load(split("\0".join(exact), "\0")), spark)
        return _as_pages(_packed(found))

    try:
        return read(paths)
    except AnalysisException as error:
        if missing_path is None or "PATH_NOT_FOUND" not in str(error):
            raise
    files = Store(spark, "")
    gone = [path for path in paths if not files.exists(path)]
    rows = spark.createDataFrame([(path,) for path in gone], "path string")
    rows.write.mode("append").json(missing_path)
    return read([path for path in paths if path not in set(gone)])


def object_columns(pages: DataFrame, root: str) -> DataFrame:
    """Add ``bucket`` (the folder) and ``name`` (the path below it) to pages of a folder."""
    bucket = root.rstrip("/")
    name = F.substring_index(F.col("path"), f"{bucket}/", -1)
    return pages.withColumns({"bucket": F.lit(bucket), "name": name})


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a landing table."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def stream_table(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of a landing table as a stream of pages."""
    return (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def spread(pages: DataFrame) -> DataFrame:
    """The same pages dealt over all cores. A file is read by one task for each of its row
    groups, often one in all, and reading a page takes some hundred times its shuffle."""
    return pages.repartition(pages.sparkSession.sparkContext.defaultParallelism, "path", "time_created")


def land(fetched: DataFrame) -> DataFrame:
    """Fetched pages ``url, html, fetched_at`` as landing rows."""
    return fetched.select(
        tx.landing_path(tx.url_username(F.col("url")), F.col("fetched_at")).alias("path"),
        "html",
        F.col("fetched_at").cast("timestamp").alias("time_created"),
    )


def last_landed(pages: DataFrame) -> DataFrame:
    """One page per path: a creator landed twice in a second keeps the later page.

    Of pages read from files, the place in the files decides between equal times, and
    the losing rows are found without their texts: one narrow scan, then one wide
    scan that drops them. Paths landed more than once are few, so the join is usually
    a broadcast that Spark chooses by their size, and page texts are not shuffled.
    Other frames have no places: there the texts decide, in one aggregation.
    """
    place = F.struct("time_created", "_metadata.file_path", "_metadata.row_index").alias("place")
    try:
        placed = pages.select(*pages.columns, place)
    except AnalysisException:
        return latest(pages, "path", ["time_created"])
    last = placed.groupBy("path").agg(F.max("place").alias("last"), F.count("*").alias("landed"))
    contested = last.filter("landed > 1").select(F.col("path").alias("contested"), "last")
    marked = placed.join(contested, F.col("path").eqNullSafe(F.col("contested")), "left")
    return marked.filter(F.col("last").isNull() | (F.col("last") == F.col("place"))).select(*pages.columns)
