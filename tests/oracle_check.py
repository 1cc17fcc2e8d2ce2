"""Run registered queries against their SQL in DuckDB and report every difference.

    python -m tests.oracle_check FOLDER [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}" if v else "0"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got = spark_df.collect()
    rel = con.sql(sql)
    want = rel.fetchall()
    types = dict(zip(rel.columns, map(str, rel.types), strict=True))
    names = spark_df.columns
    if sorted(names) != sorted(types):
        return f"columns {sorted(names)} != {sorted(types)}"
    kinds = {n: (KINDS.get(t, t), types[n]) for n, t in spark_df.dtypes if KINDS.get(t, t) != types[n]}
    a, b = rows_of(names, got), rows_of(list(types), want)
    if a != b:
        extra, lack = list(set(a) - set(b))[:3], list(set(b) - set(a))[:3]
        return f"rows {len(a)} vs {len(b)}; only spark {extra}; only sql {lack}"
    if kinds:
        return f"types {kinds}"
    return None if a else "EMPTY"


def main(folder: str, parts: list[str]) -> int:
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(fn(spark, folder), con, sqls[name])
            else:
                problem = None if fn(spark, folder).count() else "EMPTY"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        kind = "" if name in sqls else " (rows only)"
        print(f"{'ok  ' if problem is None else 'DIFF'} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
