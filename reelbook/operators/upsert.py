"""Latest state per key: deduplication, merge, and a table that takes batches.

``LatestTable`` keeps an append-only log of batches and, now and then, a
published snapshot. Taking a batch costs work in proportion to the batch. A
batch that is replayed replaces itself, and nothing is overwritten in place.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelbook.session import Store

#: Where a row comes from; later rows win in this order.
ORIGIN = ("page_time", "page_path", "position")
_ORIGIN_SCHEMA = [
    T.StructField("page_time", T.TimestampType()),
    T.StructField("page_path", T.StringType()),
    T.StructField("position", T.IntegerType()),
]

def latest(rows: DataFrame, key: str, order: Sequence[str], hashed: bool = False) -> DataFrame:
    """The last row of each key by ``order``; equal orders are decided by the row values.

    One aggregation: each task reduces its rows to one per key before the
    shuffle, so a key with very many rows costs no more than any other. The rows are
    sorted by key for it. With ``hashed`` they are sorted by a hash of the key first:
    paths and URLs begin alike, so comparing them takes longer than comparing numbers.
    The result is then not dealt by the key alone.
    """
    columns = [name for name in rows.columns if name != key]
    last = F.max(
        F.struct(F.struct(*order).alias("order"), F.struct(*columns).alias("row"))
    ).alias("last")
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(*([F.xxhash64(key).alias("key_hash")] if hashed else []), key)
        .agg(last)
        .select(*[F.col(key) if name == key else F.col(f"last.row.{name}") for name in rows.columns])
    )


def merge_upsert(
    target: DataFrame, source: DataFrame, key: str, order: Sequence[str] | None = None
) -> DataFrame:
    """``target`` with each row of ``source`` updating or inserting its key.

    A matched row takes every column from the source, NULL included. Rows of the
    target without a source row stay. With ``order`` the source is reduced to its
    last row per key first; that aggregation and the join share one shuffle.
    """
    columns = target.columns
    update = source.filter(F.col(key).isNotNull()) if order is None else latest(source, key, order)
    pack = lambda frame, name: frame.select(
        key, F.struct(*[c for c in columns if c != key]).alias(name)
    )
    joined = pack(target, "old").join(pack(update, "new"), key, "full_outer")
    merged = joined.select(
        key, F.when(F.col("new").isNotNull(), F.col("new")).otherwise(F.col("old")).alias("row")
    )
    return merged.select(*[F.col(key) if c == key else F.col(f"row.{c}") for c in columns])


class LatestTable:
    """Latest state per key at ``path``, fed by numbered batches.

    ``order="arrival"``: the later batch wins, whatever its page time.
    ``order="event_time"``: the later page wins, whatever its batch.

    A batch number belongs to one batch: taking it again replaces it, and folding it
    again changes nothing. A snapshot is kept in folders (buckets) by the hash of the
    key, and publishing rewrites only those that newer batches touch. Their number
    follows the size of the table: it doubles, and the table is rewritten once, when a
    bucket would hold more than ``bucket_rows`` rows on average; ``buckets`` fixes it.
    ``more`` columns are stored beside those of the table and read when asked for.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        order: str = "arrival",
        buckets: int | None = None,
        more: Sequence[T.StructField] = (),
        bucket_rows: int = 500_000,
    ):
        if order not in ("arrival", "event_time"):
            raise ValueError(f"unknown order: {order}")
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.columns = schema.fieldNames()
        self._stored = [*self.columns, *(field.name for field in more)]
        self.order = (
            ("batch_id", *ORIGIN) if order == "arrival" else ("page_time", "batch_id", *ORIGIN[1:])
        )
        self.buckets, self.bucket_rows = buckets, bucket_rows
        self._store = Store(spark, self.path)
        batch = T.StructField("batch_id", T.LongType())
        self._schema = T.StructType([*schema.fields, *more, *_ORIGIN_SCHEMA, batch])

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Take a batch: the stored columns and the :data:`ORIGIN` columns.

        The batch is reduced to one row per key. Rows with a NULL key are refused.
        """
        batch = latest(rows.select(*self._stored, *ORIGIN), self.key, ORIGIN, hashed=True)
        batch.write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")

    def publish(self, share: float = 0) -> None:
        """Fold the newer batches into a new snapshot and make it the one that is read.

        Without newer batches nothing is written, and none are folded while they hold fewer
        rows than this ``share`` of the snapshot: a table published again and again with a
        share of 1 is rewritten each time it doubles, so that all snapshots together hold
        some twice its rows, however many batches it came in. Of two callers at once, the one
        with the higher version decides; what the other folded is folded again.
        """
        head = self._head()
        newer = self._newer(head)
        if not newer:
            return
        log, held = self._log(newer), sum(head["rows"].values())
        added = log.count()
        if added < share * held:
            return
        version = 1 + max([head["version"], *map(int, self._store.names("versions"))])
        while not self._store.claim(f"versions/{version}"):
            version += 1
        size = max(head["size"], self.buckets or self._wanted(held + added))
        touched = self._touched(log, size) if size == head["size"] else list(head["places"])
        path = f"{self.path}/snapshot/v={version}"
        rows = self._dealt(self._both(head, log, touched, self._schema.fieldNames()), size)
        rows.write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = self.spark.read.schema(T.StructType([*self._schema.fields, T.StructField("bucket", T.IntegerType())]))
        counted = {str(r["bucket"]): r["count"] for r in written.parquet(path).groupBy("bucket").count().collect()}
        kept = {b: v for b, v in head["places"].items() if b not in touched}
        mark = {
            "version": version,
            "size": size,
            "places": kept | {b: version for b in counted},
            "rows": {b: head["rows"][b] for b in kept} | counted,
            "folded": sorted({*head["folded"], *newer} & {*self._numbers()}),
        }
        self._store.write(f"published/{version}", json.dumps(mark))

    def drop_folded(self) -> None:
        """Remove what the newest snapshot has made superfluous. Nothing may be reading it."""
        head = self._head()
        for number in head["folded"]:
            self._store.remove(f"log/batch_id={number}")
        for folder in self._store.names("snapshot"):
            for name in self._store.names(f"snapshot/{folder}"):
                if name.startswith("bucket=") and folder != f"v={head['places'].get(name[7:])}":
                    self._store.remove(f"snapshot/{folder}/{name}")
        for kind in ("published", "versions"):
            for name in self._store.names(kind):
                if name.isdigit() and int(name) < head["version"]:
                    self._store.remove(f"{kind}/{name}")

    def current(self, *columns: str) -> DataFrame:
        """One row per key, without origin columns; only ``columns`` are read if given.

        A published table without newer batches is a plain scan.
        """
        return self._state(*columns).select(*(columns or self.columns))

    def _state(self, *columns: str) -> DataFrame:
        # A batch number and an origin name one row, so leaving out columns picks no other.
        kept = [
            name
            for name in self._schema.fieldNames()
            if name not in self._stored or name in (self.key, *(columns or self.columns))
        ]
        head = self._head()
        newer = self._newer(head)
        log = self._log(newer) if newer else None
        touched = self._touched(log, head["size"]) if newer else []
        rest = self._snapshot(head, [b for b in head["places"] if b not in touched], kept)
        if not newer:
            return self.spark.createDataFrame([], self._schema).select(*kept) if rest is None else rest
        merged = self._merged(head, log, touched, kept)
        return merged if rest is None else rest.unionByName(merged)

    def _merged(self, head: dict, log: DataFrame, touched: list[str], kept: list[str]) -> DataFrame:
        """The buckets that newer batches touch, with these batches."""
        return latest(self._both(head, log, touched, kept), self.key, self.order, hashed=True)

    def _both(self, head: dict, log: DataFrame, touched: list[str], kept: list[str]) -> DataFrame:
        """Rows of some buckets and of newer batches: of each key one for each of them at most."""
        old = self._snapshot(head, touched, kept)
        rows = log.select(*kept)
        return rows if old is None else old.unionByName(rows)

    def _dealt(self, rows: DataFrame, size: int) -> DataFrame:
        """The last row of each key, with its bucket and in the order of the buckets.

        One shuffle and one sort serve the aggregation and the writer. Rows are not reduced
        before the shuffle, which would sort them once more and leave nearly all of them: no
        key has more than a row for each batch. Each bucket has several parts, so that a large
        one is spread over several tasks; small parts share one.
        """
        cores = self.spark.sparkContext.defaultParallelism
        part = F.pmod(F.xxhash64(F.lit(0), F.col(self.key)), F.lit(max(2, -(-cores // size))))
        placed = rows.withColumns({"bucket": self._bucket(size), "part": part.cast("int")})
        columns = [name for name in rows.columns if name != self.key]
        packed = F.struct(F.struct(*self.order).alias("order"), F.struct(*columns).alias("row"))
        merged = (
            placed.repartition("bucket", "part")
            .groupBy("bucket", "part", F.xxhash64(self.key).alias("key_hash"), self.key)
            .agg(F.max(packed).alias("last"))
        )
        kept = [F.col(name) if name == self.key else F.col(f"last.row.{name}") for name in rows.columns]
        return merged.select(*kept, "bucket")

    def _wanted(self, rows: int) -> int:
        """The power of two of buckets that keeps them at ``bucket_rows`` rows on average."""
        return 1 << max(0, -(-rows // self.bucket_rows) - 1).bit_length()

    def _bucket(self, size: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(size)).cast("int")

    def _touched(self, log: DataFrame, size: int) -> list[str]:
        if size <= 1:
            return ["0"]
        found = log.select(self._bucket(size).alias("b")).distinct()
        return [str(row.b) for row in found.collect()]  # at most ``size`` numbers

    def _read(self, *places: str) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(*places)

    def _snapshot(self, head: dict, buckets: Sequence[str], kept: list[str]) -> DataFrame | None:
        """Some buckets of the snapshot; None if it has none of them."""
        places = [f"{self.path}/snapshot/v={head['places'][b]}/bucket={b}" for b in buckets if b in head["places"]]
        return self._read(*places).select(*kept) if places else None

    def _log(self, numbers: list[int]) -> DataFrame:
        places = [f"{self.path}/log/batch_id={n}" for n in numbers]
        return self.spark.read.schema(self._schema).option("basePath", f"{self.path}/log").parquet(*places)

    def _numbers(self) -> list[int]:
        names = self._store.names("log")
        return sorted(int(name[9:]) for name in names if name.startswith("batch_id="))

    def _newer(self, head: dict) -> list[int]:
        """Whole batches that the snapshot does not hold; one that is being written is not whole."""
        return [
            n
            for n in self._numbers()
            if n not in head["folded"] and self._store.exists(f"log/batch_id={n}/_SUCCESS")
        ]

    def _head(self) -> dict:
        """The newest snapshot: its number of buckets, the version each was last written in and
        its rows, and those batches of the log that the snapshot holds."""
        versions = [int(name) for name in self._store.names("published") if name.isdigit()]
        if not versions:
            return {"version": 0, "size": 0, "places": {}, "rows": {}, "folded": []}
        return json.loads(self._store.read(f"published/{max(versions)}"))
