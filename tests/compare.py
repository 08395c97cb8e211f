"""Run registered queries next to their check SQL: python -m tests.compare [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("duelframe")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per expression
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="duelframe-checkpoints-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def difference(spark: SparkSession, con, folder: str, fun, sql: str) -> str | None:
    """None if both results agree in column names, Python types and values."""
    df = fun(spark, folder)
    got = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, expected)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if repr(x) != repr(y):
            return f"\n  spark {x}\n  check {y}"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, os.getcwd())
    import __spark_entry__ as entry

    spark, con = session(), duck(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, fun in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = difference(spark, con, folder, fun, sqls[name])
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:700]}"
        bad += found is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print("failed:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(args[0], args[1:]) > 0)
