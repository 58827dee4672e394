"""Run queries next to their SQL statements: ``python -m tests.oracle_check SF [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, folder, name) -> str:
    """Empty when rows, columns and value types agree; else what differs."""
    result = contract.queries()[name](spark, folder)
    columns, rows = canonical(result.columns, [tuple(r) for r in result.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "" if rows else "no rows"
    cursor = con.execute(sql)
    wanted_columns, wanted = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    for a, b in zip(rows, wanted):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a}\n   != {b}"
    return ""


def main(argv: list[str]) -> int:
    folder = f"/root/testdata/sf{argv[0]}"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    names = argv[1:] or list(contract.queries())
    failures = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql " if name in contract.oracle_sql() else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {problem}", flush=True)
        failures += bool(problem)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
