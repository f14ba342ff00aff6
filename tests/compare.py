"""Runs queries beside their SQL in DuckDB: python -m tests.compare SF_DIR [NAME...]"""

import hashlib
import math
import sys
import time
from pathlib import Path


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    lines = sorted("\x1f".join(plain(r[k]) for k in order) for r in rows)
    return sorted(columns), len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set threads=4")
    for p in Path(sf_dir).iterdir():
        if p.name.endswith(".parquet"):
            con.execute(f"create view {p.name[:-8]} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def compare(spark, con, sf_dir, name, query, sql):
    t = time.time()
    df = query(spark, sf_dir)
    mine = digest(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    if sql is None:
        return f"rows only: {mine[1]}", took
    rel = con.sql(sql)
    theirs = digest(list(rel.columns), rel.fetchall())
    if mine[:3] == theirs[:3]:
        return f"same: {mine[1]}", took
    a, b = set(mine[3]), set(theirs[3])
    return f"DIFFERENT {mine[:2]} {theirs[:2]}\n    mine   {sorted(a - b)[:3]}\n    theirs {sorted(b - a)[:3]}"[:1500], took


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "6").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sys.argv[1])
    queries, sql = e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or queries:
        try:
            said, took = compare(spark, con, sys.argv[1], name, queries[name], sql.get(name))
        except Exception as x:  # noqa: BLE001
            said, took = f"FAILED {type(x).__name__}: {str(x)[:700]}", 0
        print(f"{name} ({took:.1f} s): {said}", flush=True)
