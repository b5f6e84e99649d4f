"""Run a registered query in Spark and its SQL in DuckDB; compare like the driver.

Compare = same row count, same column names, and equal multisets of rows
after sorting columns by name (floats compared after rounding to 6 places).
"""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} differing rows, first: spark={diff[0][0]} duck={diff[0][1]}")
    return len(srows), problems


def main(argv):
    sys.path.insert(0, "/root/repo")
    import time
    import __spark_entry__ as E
    from devpulse.session import local_session
    sf_dir = "/root/testdata/sf0.01"
    spark = local_session("8")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    names = [n for n in qs if not argv or any(a in n for a in argv)]
    bad = 0
    for name in names:
        t = time.time()
        try:
            n, problems = compare(spark, con, qs[name], sqls[name], sf_dir) if name in sqls else (None, ["no sql"])
        except Exception as exc:  # noqa: BLE001
            n, problems = None, [f"error {type(exc).__name__}: {str(exc)[:400]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:45s} rows={n} {time.time() - t:5.1f}s {'; '.join(problems)}",
              flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv[1:])
