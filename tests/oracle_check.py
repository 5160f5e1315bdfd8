"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest (``compare``) and from the command line::

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = False     # compare floats bit-for-bit instead of to 9 decimals


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 9)
    if hasattr(v, "isoformat") and not isinstance(v, str):
        try:
            return pd.Timestamp(v).isoformat()
        except Exception:
            return str(v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 9)
    except Exception:
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in row) for row in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spd = sdf.toPandas()
    t1 = time.time()
    dpd = con.execute(sql).df()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(spd), "oracle_rows": len(dpd),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    res["cols_match"] = sorted(spd.columns) == sorted(dpd.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(set(spd.columns) - set(dpd.columns))
        res["oracle_cols"] = sorted(set(dpd.columns) - set(spd.columns))
        res["ok"] = False
        return res
    a, b = _rows(spd), _rows(dpd)
    res["ok"] = a == b
    if not res["ok"] and len(a) == len(b):
        cols = sorted(spd.columns)
        diffs = {}
        for ra, rb in zip(a, b):
            for c, x, y in zip(cols, ra, rb):
                if x != y:
                    diffs.setdefault(c, []).append((x, y))
        res["diff_cols"] = {c: (len(v), v[:3]) for c, v in diffs.items()}
    return res


def main(argv):
    sys.path.insert(0, ".")
    from pricelake.plans import catalog
    from pricelake.session import get_spark

    global STRICT
    if "--strict" in argv:
        STRICT = True
        argv = [a for a in argv if a != "--strict"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        sql = catalog.SQL.get(n)
        if sql is None:
            df = catalog.QUERIES[n](spark, sf_dir)
            print({"name": n, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, con, n, catalog.QUERIES[n], sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        bad += 0 if r.get("ok") else 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
