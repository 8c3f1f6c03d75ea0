"""Reading the input tables, and small configuration frames."""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SCHEMAS: dict[tuple[str, float], object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory. Column pruning and filter pushdown reach the scan
    because everything downstream is declarative. The schema of a single file is read once per file version
    and reused, so repeated reads skip Spark's schema-inference job; a folder's may change deeper down
    and is read each time, as is that of a path only Spark can open."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (path, os.path.getmtime(path)) if os.path.isfile(path) else None
    if key is not None and key in _SCHEMAS:
        return spark.read.schema(_SCHEMAS[key]).parquet(path)
    df = spark.read.parquet(path)
    if key is not None:
        _SCHEMAS[key] = df.schema
    return df


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime):
        return f"DATE'{v.isoformat()}'"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small configuration frame (a dictionary, an expected grid) as an inline ``VALUES``
    relation: Spark evaluates it on the driver without scheduling a job, and knows its exact size
    when planning joins. ``schema`` is ``"name type, ..."``."""
    fields = [f.strip().split()[:2] for f in schema.split(",")]
    names = [f[0] for f in fields]
    if not rows:
        return spark.createDataFrame([], schema)
    casts = ", ".join(f"CAST(col{i + 1} AS {t}) AS `{n}`" for i, (n, t) in enumerate(fields))
    values = ", ".join("(" + ", ".join(_sql_value(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT {casts} FROM VALUES {values}")
    return df.toDF(*names)
