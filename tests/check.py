"""Compare query results with their SQL: ``python tests/check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, spark_df, sql):
    """None when equal, otherwise what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    want = normal_rows(names, cursor.fetchall())
    got = normal_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{str(g)[:400]} instead of {str(w)[:400]}"
    return None


def session(cpus: str = "8", partitions: str = "8", **settings: str):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tidemark").config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    from querybook import QUERIES, SQL

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, con = session(), connect(sf)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            result = compare(con, df, SQL[name]) if name in SQL else f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1200]}"
        bad += result is not None
        print(f"{'ok  ' if result is None else 'BAD '} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} ok")
