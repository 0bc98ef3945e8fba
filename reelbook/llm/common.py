"""What several operators need: tables, working tables, words of a text."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.session import configure, scratch_dir

#: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters that separate words: the blank and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
#: Byte map that lower-cases A-Z, keeps digits, letters and bytes above 127, and blanks the rest.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
#: Most rows of a side that is broadcast after its rows have been counted.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the session set up for it."""
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_working: list[list[str]] = []


def saved(frame: DataFrame, purpose: str, stay: bool = False) -> DataFrame:
    """``frame`` written to the shared working folder and read back: it is computed once.

    Within :func:`discarding` the table goes at the end, or with ``stay`` at the end of the
    block around that.
    """
    path = scratch_dir(frame.sparkSession, purpose)
    block = len(_working) - 1 - stay
    if block >= 0:
        _working[block].append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Remove the working tables saved in this block at its end.

    What the block hands on must not read them: it is saved with ``stay``.
    """
    _working.append([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for path in _working.pop():
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def maybe_broadcast(frame: DataFrame, rows: int) -> DataFrame:
    """``frame`` marked for broadcast if its counted ``rows`` are few; else left to a shuffle join."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def words_of(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and bytes above 127, A-Z lower-cased; none for a null."""
    return text.translate(FOLD).split() if text else []


def named(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct: no name added beside it can clash with theirs."""
    return F.struct(*map(named, docs.columns))


def fields(row: str, names: Sequence[str]) -> list[Column]:
    """Columns taken back out of a struct."""
    return [F.col(row).getField(name).alias(name) for name in names]


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that have one."""
    plain = [f.name for f in docs.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.xxhash64(*map(named, plain)) if plain else F.lit(0).cast("long")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(named(name), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
