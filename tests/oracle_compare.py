"""Run a registered Spark query and its DuckDB oracle side by side.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows after sorting columns by name (values compared exactly;
floats also reported when they only differ in the last bits).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact=True):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v) if exact else f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return (1, format(v.normalize(), "f") if v == v.to_integral() else str(v))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, repr(float(v)) if exact else f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x, exact) for x in v]))
    return (5, str(v))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diff(sdf, rel):
    s = {f.name.lower(): SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
         for f in sdf.schema.fields}
    d = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}


def rows_of(cols, rows, exact=True):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted(tuple(_norm(r[i], exact) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    out["cols_match"] = sorted(c.lower() for c in s_cols) == sorted(c.lower() for c in d_cols)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["ok"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["exact"] = a == b
    out["approx"] = out["exact"] or rows_of(s_cols, s_rows, False) == rows_of(d_cols, d_rows, False)
    types = type_diff(sdf, rel)
    if types:
        out["type_diff"] = types
    out["ok"] = out["exact"] and len(s_rows) == len(d_rows) and not types
    if not out["exact"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [x for x in a if x not in sb][:3]
        out["only_oracle"] = [x for x in b if x not in sa][:3]
    return out


def main(sf_dir: str, names=None):
    sys.path.insert(0, ".")
    from meteoframe.session import build_session
    import __spark_entry__ as E
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            sdf = fn(spark, sf_dir)
            print({"name": name, "rows_only": sdf.count()})
            continue
        try:
            r = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": repr(e)[:800]}
        bad += not r.get("ok")
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:] or None)
