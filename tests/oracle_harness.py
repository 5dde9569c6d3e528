"""Run registered queries next to their DuckDB oracles and compare.

Usage: python -m tests.oracle_harness [sf_dir] [key ...]

Compares row count, column names and an order-insensitive digest of the
values (doubles rounded to 9 places, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "float": "FLOAT", "date": "DATE"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 9) + 0.0
    if isinstance(v, int):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()[:16]


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    spark_s = time.time() - t0
    out = {"key": name, "rows": len(rows), "spark_s": round(spark_s, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    otypes = {d[0]: str(d[1]) for d in res.description}
    orows = res.fetchall()
    stypes = dict(df.dtypes)
    bad_types = {c: (stypes[c], otypes[c]) for c in cols
                 if c in otypes and SPARK_TO_DUCK.get(stypes[c], stypes[c]) != otypes[c]}
    if bad_types:
        out["types"] = bad_types
    out["oracle_rows"] = len(orows)
    same_cols = sorted(cols) == sorted(ocols)
    same = same_cols and len(rows) == len(orows) and digest(cols, rows) == digest(ocols, orows)
    out["status"] = "match" if same else "MISMATCH"
    if not same:
        out["cols"] = (sorted(cols), sorted(ocols)) if not same_cols else "same"
        if same_cols:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
            a = {repr(tuple(norm(r[i]) for i in order)) for r in rows}
            b = {repr(tuple(norm(r[i]) for i in oorder)) for r in orows}
            out["only_spark"] = sorted(a - b)[:3]
            out["only_oracle"] = sorted(b - a)[:3]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from blotter.plans.catalog import ORACLE, QUERIES
    from blotter.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, QUERIES[k], ORACLE.get(k), sf_dir)
        except Exception as exc:  # report and go on
            r = {"key": k, "status": "ERROR", "error": repr(exc)[:600]}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
