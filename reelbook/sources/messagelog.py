"""A log of trigger messages as a stream source with offsets.

The log is a folder with one file for each partition, ``<n>.ndjson``, that only grows:
a line is an envelope ``{"data": base64 text, "publish_time": ISO time}``. Offsets are
the ends of whole lines in bytes, so a reader that restarts reads nothing twice, and
what is still being written is left for later. ``spark.dataSource.register(MessageLog)``
makes it available as ``spark.readStream.format("messagelog").option("path", ...)``.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from datetime import datetime

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "data string, publish_time timestamp, partition string, position bigint"
#: Bytes that one task reads at most, and that are looked through at a time.
TASK_BYTES, LOOK_BYTES = 64 << 20, 1 << 16


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path there, of a URI as Spark writes it or of a local path."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path.rstrip("/")))


class Stretch(InputPartition):
    """Whole lines of one file from ``start`` to ``stop``."""

    def __init__(self, name: str, start: int, stop: int):
        self.name, self.start, self.stop = name, start, stop


class MessageLog(DataSource):
    """Source ``messagelog`` with the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "messagelog"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"])


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def _files(self) -> tuple[fs.FileSystem, str]:
        return _place(self.path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The end of the last whole line of each partition."""
        system, root = self._files()
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return {f.base_name[:-7]: self._end(system, f.path, f.size) for f in found if f.base_name.endswith(".ndjson")}

    @staticmethod
    def _end(system: fs.FileSystem, path: str, size: int) -> int:
        with system.open_input_file(path) as file:
            stop = size
            while stop > 0:
                start = max(0, stop - LOOK_BYTES)
                file.seek(start)
                at = file.read(stop - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                stop = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        """Stretches of about :data:`TASK_BYTES`; each begins and ends with a line."""
        system, root = self._files()
        stretches = []
        for name, stop in sorted(end.items()):
            at = start.get(name, 0)
            while stop - at > TASK_BYTES:
                cut = self._end(system, f"{root}/{name}.ndjson", at + TASK_BYTES)
                if cut <= at:  # a line longer than a task's share: one task takes the rest
                    break
                stretches.append(Stretch(name, at, cut))
                at = cut
            if stop > at:
                stretches.append(Stretch(name, at, stop))
        return stretches

    def read(self, partition: Stretch) -> Iterator[tuple]:
        system, root = self._files()
        with system.open_input_file(f"{root}/{partition.name}.ndjson") as file:
            file.seek(partition.start)
            at, rest, left = partition.start, b"", partition.stop - partition.start
            while left:
                block = file.read(min(left, 1 << 20))
                left -= len(block)
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    yield (*_envelope(line), partition.name, at)
                    at += len(line) + 1

    def commit(self, end: dict) -> None:
        """Nothing to give back: the log keeps its messages."""


def _envelope(line: bytes) -> tuple[str | None, datetime | None]:
    """Payload and time of a line; NULL what it does not say, so no message stops the stream."""
    try:
        found = json.loads(line)
        data, time = found.get("data"), found.get("publish_time")
        when = datetime.fromisoformat(time) if isinstance(time, str) else None
    except (ValueError, AttributeError):
        return None, None
    return (data if isinstance(data, str) else None), when


def stream_log(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a log as a stream: ``data, publish_time, partition, position``."""
    spark.dataSource.register(MessageLog)
    return spark.readStream.format("messagelog").option("path", path).load()


def append_messages(messages: DataFrame, path: str, partitions: int = 4, first: int = 0) -> None:
    """Add ``data, publish_time`` to a log as new partitions ``first`` and on, one task each."""

    def write(batches) -> Iterator:
        from pyspark import TaskContext

        system, place = _place(path)
        system.create_dir(place, recursive=True)
        name = f"{place}/{first + TaskContext.get().partitionId()}.ndjson"
        # a draft first: a task that runs again replaces it, a reader never sees half of it
        with system.open_output_stream(f"{name}.draft") as file:
            for batch in batches:
                for line in batch.column(0).to_pylist():
                    file.write(line.encode() + b"\n")
        system.move(f"{name}.draft", name)
        yield from ()

    lines = messages.selectExpr("to_json(struct(data, date_format(publish_time, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\") AS publish_time)) AS line")
    lines.repartition(partitions, "line").mapInArrow(write, "done boolean").write.format("noop").mode("overwrite").save()
