"""Spark vs DuckDB parity for the driver queries.

Usage: python -m tests.parity [sf_dir] [name ...]

Compares, per query: column names, row count, and the multiset of rows with
columns sorted by name and floats rounded to 6 places.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

from hourcast.sources.analog import DRIVER_TABLES


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def normalise(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(df, con, sql: str) -> dict:
    """Columns whose Spark and DuckDB types differ."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def compare(spark, con, name: str, build, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = build(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["ok"] = None
        return out
    t0 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["duck_sec"] = round(time.time() - t0, 2)
    out["duck_rows"] = len(d_rows)
    s_names, s_set = normalise(df.columns, s_rows)
    d_names, d_set = normalise(d_cols, d_rows)
    out["cols_ok"] = s_names == d_names
    out["rows_ok"] = s_set == d_set
    types = type_mismatches(df, con, sql)
    out["types_ok"] = not types
    if types:
        out["types"] = types
    out["ok"] = out["cols_ok"] and out["rows_ok"] and out["types_ok"]
    if not out["cols_ok"]:
        out["cols"] = (sorted(set(s_names) - set(d_names)), sorted(set(d_names) - set(s_names)))
    elif not out["rows_ok"]:
        only_s = list((s_set - d_set).elements())[:2]
        only_d = list((d_set - s_set).elements())[:2]
        out["diff"] = {"names": s_names, "spark_only": only_s, "duck_only": only_d,
                       "n_spark_only": sum((s_set - d_set).values())}
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from hourcast.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]")
    con = duck_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, build, oracle.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
