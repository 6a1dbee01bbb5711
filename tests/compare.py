"""Compare a Spark query with its DuckDB oracle: row count, column names and an
order-insensitive value digest (used by tests and the local check script)."""

from __future__ import annotations

import datetime as _dt
import hashlib
import math

import duckdb
from pyspark.sql import DataFrame

from lakeshift.plans.frames import BASE_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, _dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def spark_digest(df: DataFrame):
    return digest(df.columns, [tuple(r) for r in df.collect()])


def duck_digest(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return digest(cols, cur.fetchall())


def main(argv: list[str] | None = None) -> int:
    """``PYTHONPATH=. python tests/compare.py <sf_dir> [name ...]``: print one line per query."""
    import sys
    import time

    from lakeshift.plans import registry
    from lakeshift.session import local_session

    args = list(sys.argv[1:] if argv is None else argv)
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(registry.QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            ours = spark_digest(registry.QUERIES[name](spark, sf_dir))
        except Exception as exc:  # report and go on
            print(f"{name:50s} SPARK-ERROR {str(exc).splitlines()[0][:200]}")
            bad += 1
            continue
        sql = registry.ORACLE.get(name)
        if sql is None:
            print(f"{name:50s} rows={ours[0]:>7} (rows-only) {time.time() - t0:.1f}s")
            continue
        try:
            theirs = duck_digest(con, sql)
        except Exception as exc:
            print(f"{name:50s} DUCK-ERROR {str(exc).splitlines()[0][:200]}")
            bad += 1
            continue
        ok = ours == theirs
        bad += not ok
        detail = "" if ok else f" ours={ours[0]} {ours[1]} theirs={theirs[0]} {theirs[1]}"
        print(f"{name:50s} {'OK ' if ok else 'BAD'} rows={ours[0]:>7} {time.time() - t0:.1f}s{detail}")
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
