"""Sharding by minimax contiguous partition.

Equal texts fall into the same cell of a fixed grid over the hash of the text; the
cells in hash order are the atomic groups. Their sizes, at most ``CELLS`` numbers
however large the corpus is, come to the driver. A binary search finds the smallest
capacity with which a greedy walk needs no more than the wanted number of shards.
Within that capacity the cuts are put as near to equal sizes as they can be.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelbook.llm.common import fields, named, saved, text_or_empty

#: log2 of the cells. A shard then has thousands of them, and is even to a fraction of a percent.
CELL_BITS = 18
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Parts of a cell that are numbered apart, so that a group of equal texts is no single task.
PARTS = 64


def fits(sums: np.ndarray, capacity: int, shards: int) -> bool:
    """Whether a greedy walk over cells with running ``sums`` (from 0) needs at most ``shards``."""
    at, n = 0, len(sums) - 1
    for _ in range(shards):
        at = int(np.searchsorted(sums, sums[at] + capacity, "right")) - 1
        if at >= n:
            return True
    return n == 0


def cuts(sizes: Sequence[int], shards: int) -> tuple[int, list[int]]:
    """The least capacity, and the ``shards + 1`` places in ``sizes`` where shards begin and end."""
    sizes = np.asarray(sizes, np.int64)
    sums = np.r_[0, np.cumsum(sizes)]
    total, n = int(sums[-1]), len(sizes)
    low = max(-(-total // shards), int(sizes.max(initial=0)))
    high = low + int(sizes.max(initial=0))  # the average and the largest group are always enough
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(sums, middle, shards) else (middle + 1, high)
    # first place from which the shards after a cut are enough
    first = [n]
    for _ in range(shards):
        first.append(int(np.searchsorted(sums, sums[first[-1]] - low, "left")))
    first = first[::-1]
    places = [0]
    for j in range(1, shards):
        last = int(np.searchsorted(sums, sums[places[-1]] + low, "right")) - 1
        want = total * j / shards
        near = int(np.searchsorted(sums, want))
        if near and want - sums[near - 1] <= sums[min(near, n)] - want:
            near -= 1
        places.append(min(max(near, first[j], places[-1]), last))
    return low, [*places, n]


def shard(
    docs: DataFrame, shards: int = 40, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep`` columns, ``size``, ``text_crc32``, ``shard`` (0 to ``shards - 1``) and ``slot``.

    ``size`` is the UTF-8 length of the text plus 16; a null text has no bytes and
    counts as an empty one. Shards are near equal in bytes; equal texts stay together;
    slots count from 0 without gaps, in hash order and by the first kept column. Rows
    are all kept, repeated ones too; without rows the result is empty. Kept columns
    with the names added here are replaced.
    """
    added = ("size", "text_crc32", "shard", "slot")
    kept = [c for c in keep if c not in added]
    body = text_or_empty(text)
    rows = docs.select(
        F.struct(*map(named, kept)).alias("row"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 64 - CELL_BITS).alias("cell"),
        F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).alias("part"),
    )
    rows = saved(rows, "rows")
    parts = rows.groupBy("cell", "part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    parts = saved(parts, "parts")
    found = parts.groupBy("cell").agg(F.sum("bytes").alias("bytes")).toArrow()
    cells = found.column("cell").to_numpy()
    order = np.argsort(cells)
    cells = cells[order]
    _, places = cuts(found.column("bytes").to_numpy()[order], shards)
    # the first cell of every shard but the first; of an empty shard, the next one's
    starts = [int(cells[p]) if p < len(cells) else 1 << CELL_BITS for p in places[1:-1]]
    shard_no = _count_reached(F.col("cell"), starts)
    before = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("shard", shard_no).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    order_by = [F.col("row").getField(kept[0]), F.col("text_crc32")] if kept else [F.col("text_crc32")]
    number = F.row_number().over(Window.partitionBy("cell", "part").orderBy(*order_by))
    rows = rows.join(parts.select("cell", "part", "shard", "before"), ["cell", "part"])
    return rows.select(
        *fields("row", kept),
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + number - 1).cast("long").alias("slot"),
    )


def _count_reached(cell: Column, starts: list[int]) -> Column:
    """How many of the ascending ``starts`` are at most ``cell``."""
    limits = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>") if starts else F.array()
    return F.size(F.filter(limits, lambda s: s <= cell)).cast("int")


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """Write ``docs`` with ``shard`` and ``slot`` as one folder per shard, in slot order."""
    rows = shard(docs, shards, keep=docs.columns)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame) -> DataFrame:
    rows = shard(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
