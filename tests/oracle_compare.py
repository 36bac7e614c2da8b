"""Compare each registered Spark query with its DuckDB statement.

Usage: ``python -m tests.oracle_compare [sf_dir] [key ...]``.  Prints one line
per key (rows, match) and exits non-zero on any mismatch.  The same routine
backs ``tests/test_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

from rosterflow.sources.tables import DRIVER_TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of_spark(df):
    names = df.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_norm(r[i]) for i in order) for r in df.collect())
    return [names[i] for i in order], rows


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    return [names[i] for i in order], rows


def compare(spark, sf_dir, key, builder, sql, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    s_names, s_rows = rows_of_spark(builder(spark, sf_dir))
    t1 = time.time()
    if sql is None:
        return {"key": key, "rows": sum(s_rows.values()), "match": None, "spark_s": t1 - t0}
    d_names, d_rows = rows_of_duck(con, sql)
    res = {"key": key, "rows": sum(s_rows.values()), "oracle_rows": sum(d_rows.values()),
           "names_match": s_names == d_names, "match": s_names == d_names and s_rows == d_rows,
           "spark_s": round(t1 - t0, 2)}
    if not res["match"]:
        res["spark_cols"], res["oracle_cols"] = s_names, d_names
        only_s = list((s_rows - d_rows).items())[:3]
        only_d = list((d_rows - s_rows).items())[:3]
        res["only_spark"], res["only_oracle"] = only_s, only_d
    return res


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")]
    import __spark_entry__ as ent
    from rosterflow.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = ent.queries(), ent.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # report and continue
            r = {"key": k, "error": repr(e)[:600]}
        ok = r.get("match") is not False and "error" not in r
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
