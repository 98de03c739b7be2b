"""Run registered queries against their DuckDB oracles: ``python -m tests.oracle [folder] [name...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from geoloom.plans.fixtures import TABLES


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("checks")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    """Values keep their type, so 1, 1.0 and Decimal(1) differ."""
    if isinstance(v, float):
        return ("float", "NaN" if math.isnan(v) else round(v, 9) + 0.0)
    if isinstance(v, (bool, Decimal)):
        return (type(v).__name__, v)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got[0] else "no columns"
    res = con.execute(sql)
    want = _rows([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}; first {got[1][:2]} / {want[1][:2]}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return None if not bad else f"{len(bad)} of {len(got[1])} rows differ, e.g. {bad[:2]}"


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), duck(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} passed")


if __name__ == "__main__":
    main()
