"""Spark result vs DuckDB oracle: row count, column names and an order-insensitive value check."""

from __future__ import annotations

import datetime as _dt
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    data = rel.fetchall()
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=_key)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "boolean": "BOOLEAN"}


def types_differ(spark_df, con, sql) -> dict:
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema}
    rel = con.sql(sql)
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}


def compare(spark_df, con, sql) -> tuple[bool, str]:
    diff = types_differ(spark_df, con, sql)
    if diff:
        return False, f"types differ: {diff}"
    sc, sr = rows_of_spark(spark_df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(sr)} rows match"
