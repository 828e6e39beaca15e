"""Run registered queries on Spark and on DuckDB and compare rows.

Usage: python -m tests.oracle [sf] [name-prefix ...]
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


def make_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def make_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, fn, sql, sf_dir):
    """Problem text, or '' when both sides agree, plus the number of rows."""
    df = fn(spark, sf_dir)
    cols, rows = normalized(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "", len(rows)
    cur = con.execute(sql)
    dcols, drows = normalized([d[0] for d in cur.description], cur.fetchall())
    if cols != dcols:
        return f"columns differ: {cols} / {dcols}", len(rows)
    if len(rows) != len(drows):
        extra = list(set(map(repr, rows)) - set(map(repr, drows)))[:2]
        missing = list(set(map(repr, drows)) - set(map(repr, rows)))[:2]
        return f"rows differ: {len(rows)} / {len(drows)}\n   spark only {str(extra)[:600]}\n   duckdb only {str(missing)[:600]}", len(rows)
    for a, b in zip(rows, drows):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
            return f"values differ: {str(diff)[:900]} in row {str(a)[:200]}", len(rows)
    return "", len(rows)


def main(argv):
    import __spark_entry__ as e

    sf = argv[0] if argv else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), make_duckdb(sf_dir)
    sql = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if len(argv) > 1 and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, fn, sql.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001
            problem, n = f"{type(exc).__name__}: {str(exc)[:1200]}", -1
        bad += bool(problem) or n == 0
        state = "FAIL" if problem else ("EMPTY" if n == 0 else "ok")
        print(f"{state:5} {name} rows={n} {time.time() - start:.1f}s {'' if name in sql else '[rows only]'} {problem}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
