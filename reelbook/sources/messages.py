"""Trigger messages: base64 text of a profile URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.functions import text as tx

MESSAGE_SCHEMA = "data string, publish_time timestamp"


def stream_messages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """JSON message files as a stream; any streaming DataFrame with these columns will do."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def decode(messages: DataFrame) -> DataFrame:
    """Add ``url`` (NULL where the payload is not base64 of UTF-8 text) and ``username``.

    The text is taken as it is: a trailing newline stays in the URL.
    """
    url = tx.decode_payload(F.col("data"))
    return messages.withColumn("url", url).withColumn("username", tx.url_username(F.col("url")))
