"""Run the registered queries and their SQL side by side.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def cell(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(map(cell, v))
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, query, statement, sf_dir):
    """Empty text if both sides agree, else what differs."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    got = bag(df.columns, rows)
    if statement is None:
        return "" if rows else "no rows"
    cur = con.execute(statement)
    columns = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    want = bag(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    odd = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema
           if KINDS.get(f.dataType.simpleString()) != kinds[f.name]}
    if got != want:
        return (f"{sum(got.values())} vs {sum(want.values())} rows; only spark "
                f"{list((got - want).items())[:2]}; only sql {list((want - got).items())[:2]}")
    if odd:
        return f"types {odd}"
    return "" if rows else "no rows"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from clickmill.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    local = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    if os.environ.get("PLAIN_SESSION"):  # Spark's defaults instead of the library's settings
        builder = SparkSession.builder.master("local[8]")
        for key, value in local.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session(master="local[8]", **local)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = oracle_connection(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in only or queries:
        start = time.time()
        try:
            result = compare(spark, con, queries[name], sqls.get(name), sf_dir)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(result)
        flag = "ok" if not result else "FAIL"
        print(f"{flag:5}{name:26}{time.time() - start:7.2f}s {'' if name in sqls else 'rows-only'} {result}", flush=True)
    print(f"{len(only or queries)} queries, {bad} bad; without SQL: {[n for n in queries if n not in sqls]}")


if __name__ == "__main__":
    main()
