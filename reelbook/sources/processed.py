"""Processed records as newline-delimited JSON, and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelbook.operators.upsert import latest, merge_upsert
from reelbook.schemas import PROFILE_KEY, PROFILE_SCHEMA, VIDEO_KEY, VIDEO_SCHEMA
from reelbook.session import scratch_dir

#: Partition column of catalog tables without row-level MERGE, and the property with its size.
BUCKET, BUCKETS = "bucket", "reelbook.buckets"
_TABLES = {"profiles": (PROFILE_SCHEMA, PROFILE_KEY), "videos": (VIDEO_SCHEMA, VIDEO_KEY)}


def write_json(rows: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per line, NULL fields included."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Records of ``profiles`` or ``videos``; bad rows and NULL keys fail the read."""
    schema, key = _TABLES[name]
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    required = F.coalesce(F.col(key), F.raise_error(F.lit(f"{name}: {key} is null")).cast("string"))
    return rows.withColumn(key, required)


class MergeUnsupported(RuntimeError):
    """A catalog table takes no row-level MERGE and has no buckets to rewrite instead."""


def create_tables(spark: SparkSession, database: str, location: str | None = None, buckets: int | None = None) -> None:
    """Create the database (at ``location`` if given) and its two tables if they do not exist.

    With ``buckets`` each table is partitioned by a last column ``bucket``, the hash of its
    key modulo ``buckets``, so that :func:`upsert_table` can rewrite parts of it.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, (schema, _) in _TABLES.items():
        columns = ", ".join(_column(field) for field in schema.fields)
        if buckets:
            columns += f", {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) TBLPROPERTIES ('{BUCKETS}' = '{buckets}'"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns})")
        else:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def _column(field: T.StructField) -> str:
    required = "" if field.nullable else " NOT NULL"
    return f"{field.name} {field.dataType.simpleString()}{required}"


def publish_table(rows: DataFrame, table: str) -> None:
    """Replace the content of a catalog table that ``rows`` is not read from; columns go by name."""
    spark = rows.sparkSession
    columns = spark.table(table).columns
    if BUCKET in columns and BUCKET not in rows.columns:
        rows = rows.withColumn(BUCKET, _bucket(spark, table, _key_of(spark, table)))
    rows.select(*columns).write.insertInto(table, overwrite=True)


def merge_statement(table: str, key: str, columns: list[str]) -> str:
    """Row-level MERGE of the relation ``{source}`` into ``table``: by name, updating and inserting."""
    q = lambda name: f"`{name}`"
    changes = ", ".join(f"t.{q(c)} = s.{q(c)}" for c in columns if c != key)
    names, values = ", ".join(map(q, columns)), ", ".join(f"s.{q(c)}" for c in columns)
    return (
        f"MERGE INTO {table} AS t USING {{source}} AS s ON t.{q(key)} = s.{q(key)} "
        f"WHEN MATCHED THEN UPDATE SET {changes} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def upsert_table(rows: DataFrame, table: str, key: str, order: Sequence[str] | None = None) -> str:
    """Update and insert ``rows`` by ``key`` in a catalog table; returns how: ``merge`` or ``buckets``.

    Matched rows take every column, NULL included; others stay; rows with a NULL key are
    refused. With ``order`` the rows are first reduced to the last of each key; without
    it keys must not repeat. Where the catalog has row-level operations this is one
    ``MERGE``. Else the buckets that the rows touch are merged with them and replaced
    (dynamic partition overwrite): 150 rows rewrite at most 150 buckets. That
    can be repeated after a failure, but readers may see some buckets before others,
    and there may be one writer at a time. A table with neither is refused with
    :class:`MergeUnsupported` before anything is written.
    """
    spark = rows.sparkSession
    columns = [c for c in spark.table(table).columns if c != BUCKET]
    rows = rows.select(*dict.fromkeys([*columns, *(order or [])]))
    rows = rows.where(F.col(key).isNotNull()) if order is None else latest(rows, key, order)
    rows = rows.select(*columns)
    bucketed = BUCKET in spark.table(table).columns
    try:
        if not bucketed:
            spark.sql(merge_statement(table, key, columns), source=rows)
            return "merge"
    except (AnalysisException, UnsupportedOperationException) as error:
        if "MERGE" not in str(error).upper():
            raise
        raise MergeUnsupported(
            f"{table}: its source has no row-level MERGE; create it with create_tables(..., buckets=n), "
            "or in a catalog that has"
        ) from error
    update = rows.withColumn(BUCKET, _bucket(spark, table, key))
    path = scratch_dir(spark, "upsert")
    update.write.partitionBy(BUCKET).parquet(f"{path}/rows")
    update = spark.read.schema(update.schema).parquet(f"{path}/rows")
    touched = [row[0] for row in update.select(BUCKET).distinct().collect()]  # at most the number of buckets
    if not touched:
        return "buckets"
    old = spark.table(table).where(F.col(BUCKET).isin(touched))
    if old.isEmpty():
        done = update  # nothing to merge with: no join and its shuffle
    else:
        merged = merge_upsert(old.drop(BUCKET), update.drop(BUCKET), key)
        done = merged.withColumn(BUCKET, _bucket(spark, table, key))
    done = done.select(*spark.table(table).columns)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        # One task for each bucket, so a bucket is one file. Dynamic overwrite writes elsewhere and
        # moves the files at the end, so the buckets may be read while they are replaced.
        done.repartition(BUCKET).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    return "buckets"


def _key_of(spark: SparkSession, table: str) -> str:
    return _TABLES[table.rsplit(".", 1)[-1]][1]


def _bucket(spark: SparkSession, table: str, key: str) -> Column:
    size = spark.sql(f"SHOW TBLPROPERTIES {table} ('{BUCKETS}')").first()["value"]
    return F.pmod(F.xxhash64(key), F.lit(int(size))).cast("int")
