"""What the last-arrival rule does: a row for each time an older scrape replaces a newer one."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OVERWRITES = "username string, arrival bigint, scrape_timestamp timestamp, replaced_arrival bigint, replaced_timestamp timestamp"
_FOUND = "username string, arrival bigint, time bigint, replaced_arrival bigint, replaced_time bigint"


class OverwriteAudit(StatefulProcessor):
    """Keeps what holds each creator's place: arrival number and scrape time (microseconds).

    Rows of a trigger are taken in the order of their arrival; only these two numbers of
    each are held, and one state row a creator stays in RocksDB.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.holder = handle.getValueState("holder", "arrival bigint, time bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.holder.get() if self.holder.exists() else None
        for arrival, time in sorted((row.arrival, row.time) for row in rows):
            if held and time < held[1]:
                yield Row(username=key[0], arrival=arrival, time=time, replaced_arrival=held[0], replaced_time=held[1])
            held = (arrival, time)
        if held:
            self.holder.update(held)

    def close(self) -> None:
        pass


def overwrites(scrapes: DataFrame) -> DataFrame:
    """Stream of :data:`OVERWRITES`: scrapes that replace a newer one of their creator.

    ``scrapes`` is a stream with ``username``, ``arrival`` (a number that grows from
    trigger to trigger) and ``scrape_timestamp``; rows without one of them are left out.
    """
    rows = scrapes.select("username", "arrival", F.unix_micros("scrape_timestamp").alias("time")).na.drop()
    found = rows.groupBy("username").transformWithState(
        statefulProcessor=OverwriteAudit(), outputStructType=_FOUND, outputMode="Append", timeMode="None"
    )
    return found.select(
        "username", "arrival", F.timestamp_micros("time").alias("scrape_timestamp"),
        "replaced_arrival", F.timestamp_micros("replaced_time").alias("replaced_timestamp"),
    )
