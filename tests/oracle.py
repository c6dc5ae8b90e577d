"""Spark-vs-DuckDB comparison used by the oracle tests and by hand.

Mirrors the driver's check: same column names, same row count, same
multiset of rows (order-insensitive), compared with exact values after
normalising Python types (Decimal -> float, NaN -> None).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from tripmart.tables import TABLES


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def _rows(cols, raw_rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in raw_rows]
    return sorted(out, key=_key)


# Spark type -> DuckDB type name, for the schema part of the check.
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
                 "tinyint": "TINYINT", "smallint": "SMALLINT", "float": "FLOAT"}


def type_mismatches(sdf, cur) -> list:
    duck = {d[0]: str(d[1]) for d in cur.description}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        if duck.get(f.name) != want:
            out.append((f.name, f.dataType.simpleString(), duck.get(f.name)))
    return out


def compare(spark, con, name: str, sf_dir: str, spark_fn, sql: str | None) -> dict:
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["ok"] = True
        res["check"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    types = type_mismatches(sdf, cur)
    if types:
        res["types"] = types
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["ok"] = False
        res["why"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        res["ok"] = False
        res["why"] = f"row counts differ {len(a)} vs {len(b)}"
        return res
    for x, y in zip(a, b):
        if x != y:
            res["ok"] = False
            res["why"] = f"first differing row (cols {sorted(s_cols)}):\n spark={x}\n duck ={y}"
            return res
    res["ok"] = True
    return res


def main(argv):
    import os
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tripmart.session import build_session

    sf_dir = os.environ.get("ORACLE_SF", "/root/testdata/sf0.01")
    names = argv[1:]
    import os
    if os.environ.get("PLAIN_SESSION"):
        # What a caller with no tripmart settings gets (Spark defaults).
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session("local[8]", 8)
    if os.environ.get("FORCE_DISTRIBUTED"):
        # Ordered sets are numbered over many small range partitions.
        from tripmart.operators import _plan
        _plan.ROWS_PER_RANGE = 50
    if os.environ.get("SESSION_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    con = duck_connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names or sorted(qs):
        try:
            r = compare(spark, con, n, sf_dir, qs[n], sqls.get(n))
        except Exception as e:  # report and go on
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "FAIL"), n, {k: v for k, v in r.items() if k not in ("name", "ok")},
              flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failing")


if __name__ == "__main__":
    main(sys.argv)
