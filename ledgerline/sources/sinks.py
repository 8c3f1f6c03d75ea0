"""Sinks: partitioned result tables and dated CSV exports.

* ``write_partitions`` replaces exactly the (eventDate, check) slices present in the result
  (dynamic partition overwrite), so rerunning a day replaces it instead of appending it twice.
  A rerun that yields *no* rows for a slice writes nothing for it, so the old slice would stay:
  ``replace_slices`` writes first and then removes those of the listed slices that the new result left
  untouched, so a failed job never loses the old result.
* ``export_csv`` writes the report format of the daily extracts: ``;`` separated, every field
  quoted, header, Windows-1251, ``yyyy-MM-dd HH:mm:ss`` timestamps, into a directory named after
  the run day. Spark has no zip codec; ``compression="gzip"`` gives the compressed copy.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

CSV_OPTIONS = {
    "sep": ";",
    "quoteAll": "true",
    "header": "true",
    "encoding": "windows-1251",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str] = ("eventDate", "cpName"),
                     fmt: str = "parquet", max_records_per_file: int = 5_000_000) -> None:
    """Write ``df`` under ``path`` partitioned by ``partition_cols``, replacing only the slices that
    occur in ``df``.

    Rows are rebalanced by the partition columns: adaptive execution merges small shuffle partitions and
    splits a slice that is larger than its target size, so there is neither a file per task and slice nor a
    slice in one task. At most ``max_records_per_file`` rows go to a file."""
    (df.hint("rebalance", *partition_cols)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", int(max_records_per_file))
       .partitionBy(*partition_cols)
       .format(fmt)
       .save(path))


def partition_dir(spark: SparkSession, values: Mapping[str, object]) -> str:
    """The folders of a slice, escaped and with NULL spelt as Spark writes them."""
    path = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(path.getPartitionPathString(
        k, v.isoformat() if isinstance(v, _dt.date) else None if v is None else str(v)) for k, v in values.items())


def clear_slices(spark: SparkSession, path: str, slices: Sequence[Mapping[str, object]]) -> int:
    """Delete the listed partition slices (e.g. ``{"eventDate": day, "cpName": "CH01"}``) of a
    table at ``path``; returns how many existed. A metadata operation on the driver, through the
    cluster's file system client."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for sl in slices:
        p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + partition_dir(spark, sl))
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed


def _slice_files(spark: SparkSession, path: str, sl: Mapping[str, object]) -> dict[str, set[str]]:
    """Leaf partition folder -> file names, for all leaves of a (possibly partial) slice."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + partition_dir(spark, sl))
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, set[str]] = {}
    if fs.exists(top):
        found = fs.listFiles(top, True)
        while found.hasNext():
            p = found.next().getPath()
            out.setdefault(p.getParent().toString(), set()).add(p.getName())
    return out


def replace_slices(df: DataFrame, path: str, slices: Sequence[Mapping[str, object]],
                   partition_cols: Sequence[str] = ("eventDate", "cpName"), **options) -> int:
    """Write ``df`` with ``write_partitions``, then remove what the new result left of ``slices``: leaves that
    existed before and got no new files hold results that no longer apply. A slice may name only the
    first partition columns and then stands for all below it. Returns the number of removed leaves."""
    spark = df.sparkSession
    before = [_slice_files(spark, path, sl) for sl in slices]
    write_partitions(df, path, partition_cols, **options)
    jvm, removed = spark.sparkContext._jvm, 0
    for sl, old in zip(slices, before, strict=True):
        now = _slice_files(spark, path, sl)
        for leaf, names in old.items():
            if now.get(leaf) == names:
                p = jvm.org.apache.hadoop.fs.Path(leaf)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
                removed += 1
    return removed


def export_dir(base: str, name: str, as_of) -> str:
    """``<base>/<name>/export_date=YYYY-MM-DD`` (S8: the dated file name becomes a dated folder)."""
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    return f"{base.rstrip('/')}/{name}/export_date={day.isoformat()}"


def export_csv(df: DataFrame, base: str, name: str, as_of, *, compression: str | None = None,
               encoding: str = "windows-1251", single_file: bool = False) -> str:
    """Write the report CSV for ``as_of`` and return its directory.

    ``single_file`` writes one part file; use it only for reports of bounded size (a pivot of a
    few thousand rows), never for record-level output. Order is kept across part files in name
    order when ``df`` is sorted."""
    spark = df.sparkSession
    out = export_dir(base, name, as_of)
    opts = dict(CSV_OPTIONS, encoding=encoding)
    if compression:
        opts["compression"] = compression
    data = df.coalesce(1) if single_file else df
    switch, legacy = "spark.sql.legacy.javaCharsets", encoding.lower().replace("_", "-") not in (
        "utf-8", "utf8", "us-ascii")
    before = spark.conf.get(switch, None)
    if legacy:
        # Spark 4 only accepts legacy Java charsets such as windows-1251 with this switch
        spark.conf.set(switch, "true")
    try:
        data.write.mode("overwrite").options(**opts).csv(out)
    finally:
        if legacy and before is None:
            spark.conf.unset(switch)
        elif legacy:
            spark.conf.set(switch, before)
    return out
