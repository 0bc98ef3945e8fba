"""Compare every registered query with its SQL. ``python tests/check.py [sf_dir] [name ...]``"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf_dir, name, run, sql):
    """Problem text, or None if rows and column names agree."""
    frame = run(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    if sql is None:
        return None
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [item[0] for item in result.description]
    types = {item[0]: str(item[1]) for item in result.description}
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        missing = [row for row in want if row not in set(got)][:2]
        extra = [row for row in got if row not in set(want)][:2]
        return f"{len(got)} rows, want {len(want)}; missing {missing}; extra {extra}"
    for field in frame.schema.fields:
        expected = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
                    "INTEGER": "int", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
        if expected.get(types[field.name], types[field.name]) != field.dataType.simpleString():
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        started = time.time()
        try:
            problem = compare(spark, sf_dir, name, queries[name], oracles.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:30s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} bad of {len(argv[1:] or queries)}; without SQL: {sorted(set(queries) - set(oracles))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
