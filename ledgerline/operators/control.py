"""Completeness and freshness control of landed data.

The original checks walk directories of landed CSV files, find the newest eligible file per
channel directory, and report channels whose newest file is not from today (stale), that have no
eligible file (missing), or whose fresh file holds only a header (empty); a second variant reports
expected region x channel pairs with no fresh file. Sending the reports is not part of this
library; the reports are DataFrames.

Two forms are offered:
* **tables** (C6): the same questions on a partitioned table, per expected (region, check) and
  ``as_of`` day: no rows, no recent rows, too few rows;
* **files** (C1-C5): on file facts (path, directory, name, length, mtime) from
  ``sources.files.list_tree``, line counts from ``sources.files.lines_up_to``.

Expected pairs and passes are configuration (a few dozen rows), built as inline frames from Python
lists; the data side is always reduced by a partial aggregation before it meets them, and Spark sizes
the joins.
"""

from __future__ import annotations

import datetime as _dt
import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.datetime import as_date
from ..sources.tables import local_frame
from ..functions.text import eligible_file_name, last_component, sql_string


def expected_pairs(spark: SparkSession, regions: Sequence[str], checks: Sequence[str],
                   region_col: str = "region", check_col: str = "check") -> DataFrame:
    """Every configured region with every configured check (the expected grid)."""
    rows = list(itertools.product(list(regions), list(checks)))
    return local_frame(spark, rows, f"{region_col} string, {check_col} string")


# ---------------------------------------------------------------------------------------------
# tables


def landed_pairs(data: DataFrame, as_of, *, region_col: str, check_col: str,
                 date_col: str = "eventDate", eligible=None,
                 out_region: str = "region", out_check: str = "check") -> DataFrame:
    """Distinct (region, check) pairs with at least one eligible row on ``as_of``."""
    day = as_date(as_of)
    d = data.where(F.col(date_col) == F.lit(day))
    if eligible is not None:
        d = d.where(eligible)
    return d.select(F.col(region_col).alias(out_region), F.col(check_col).alias(out_check)).distinct()


def expected_minus_found(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected pairs with no counterpart among the found ones (J8, C4): a ``left_anti`` join,
    which keeps an expected pair even when the found side holds NULLs (unlike ``NOT IN``)."""
    return expected.join(found, list(keys), "left_anti")


def table_freshness(data: DataFrame, expected: DataFrame, as_of, *, region_col: str,
                    check_col: str, date_col: str = "eventDate", eligible=None,
                    out_region: str = "region", out_check: str = "check") -> DataFrame:
    """Per expected pair whose newest eligible day up to ``as_of`` is not ``as_of``: the newest day
    (NULL when none) and a status, ``missing`` or ``stale`` (C2 on tables).

    The run day is read first, one day of partitions. Only the pairs not found there (configuration, at
    most the expected grid, listed on the driver) are looked for in older days, as a literal filter."""
    day = as_date(as_of)
    found = landed_pairs(data, day, region_col=region_col, check_col=check_col, date_col=date_col,
                         eligible=eligible, out_region=out_region, out_check=out_check)
    absent = [tuple(r) for r in expected_minus_found(
        expected.select(out_region, out_check), found, [out_region, out_check]).distinct().collect()]
    gap = local_frame(data.sparkSession, absent, f"{out_region} string, {out_check} string")
    if not absent:
        return gap.select(out_region, out_check, F.lit(None).cast("date").alias("last_date"),
                          F.lit("").alias("status"))
    older = data.where(F.col(date_col) < F.lit(day))
    if eligible is not None:
        older = older.where(eligible)
    pairs = ", ".join(f"({sql_string(r)}, {sql_string(c)})" for r, c in absent if r is not None and c is not None)
    older = older.where(f"(`{region_col}`, `{check_col}`) IN ({pairs})" if pairs else "FALSE")
    newest = (older.groupBy(F.col(region_col).alias(out_region), F.col(check_col).alias(out_check))
              .agg(F.max(date_col).alias("last_date")))
    return gap.join(newest, [out_region, out_check], "left").select(
        out_region, out_check, "last_date",
        F.when(F.col("last_date").isNull(), F.lit("missing")).otherwise(F.lit("stale")).alias("status"))


def table_low_volume(data: DataFrame, expected: DataFrame, as_of, *, region_col: str,
                     check_col: str, date_col: str = "eventDate", eligible=None,
                     max_rows: int = 1, exclude_checks: Sequence[str] = (),
                     out_region: str = "region", out_check: str = "check") -> DataFrame:
    """Expected pairs that did land on ``as_of`` but with at most ``max_rows`` eligible rows, checks
    in ``exclude_checks`` left out (C3 on tables: a header-only file is a file with no data). Only the
    run day is read."""
    d = data.where(F.col(date_col) == F.lit(as_date(as_of)))
    if eligible is not None:
        d = d.where(eligible)
    rows = (d.groupBy(F.col(region_col).alias(out_region), F.col(check_col).alias(out_check))
            .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") <= F.lit(int(max_rows))))
    exp = expected.where(~F.col(out_check).isin(list(exclude_checks))) if exclude_checks else expected
    return rows.join(exp, [out_region, out_check]).select(out_region, out_check, F.col("rows").cast("bigint"))


def status_rows(report: DataFrame, passes: DataFrame, *, pass_col: str, item_col: str,
                kind: str, sep: str = "\n", checked_at: _dt.datetime | None = None,
                stamp_format: str = "dd.MM.yyyy HH:mm") -> DataFrame:
    """One status row per pass: ``OK`` when the report has nothing for it, else ``NOK`` with the
    sorted items joined by ``sep`` (A8, C5). The items of a pass are bounded by its expected list,
    so the per-pass list is small by construction. With ``checked_at`` a ``checked_at`` text in
    ``stamp_format`` is added, as the status subject shows it (F16)."""
    lists = (report.groupBy(pass_col)
             .agg(F.array_join(F.sort_array(F.collect_list(item_col)), sep).alias("items"),
                  F.count(F.lit(1)).alias("n_items")))
    cols = [F.col(pass_col), F.lit(kind).alias("kind"),
            F.when(F.coalesce(F.col("n_items"), F.lit(0)) > 0, F.lit("NOK"))
            .otherwise(F.lit("OK")).alias("status"),
            F.coalesce(F.col("items"), F.lit("")).alias("items")]
    if checked_at is not None:
        stamp = F.lit(checked_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        cols.append(F.date_format(stamp, stamp_format).alias("checked_at"))
    return passes.join(lists, pass_col, "left").select(*cols)


# ---------------------------------------------------------------------------------------------
# files


def latest_eligible_files(facts: DataFrame, *, suffix: str, excludes: Sequence[str]) -> DataFrame:
    """Newest eligible file of every directory (W3): ends with ``suffix``, name contains none of
    ``excludes``; ties on mtime go to the greater path. A ``max`` over (mtime, path) structs, so
    each task pre-aggregates its share of a directory before the shuffle."""
    elig = facts.where(eligible_file_name(last_component("path"), suffix, excludes))
    newest = elig.groupBy("dir").agg(F.max(F.struct("mtime", "path")).alias("_m"))
    return newest.select("dir", F.col("_m.path").alias("path"), F.col("_m.mtime").alias("mtime"))


def file_reports(facts: DataFrame, channel_dirs: DataFrame, as_of, *, suffix: str,
                 excludes: Sequence[str], not_empty_checked: Sequence[str],
                 line_counter=None, max_lines: int = 1) -> tuple[DataFrame, DataFrame]:
    """Stale/missing and empty reports over landed files.

    ``facts``: path, dir, name, length, mtime (``sources.files.list_tree``).
    ``channel_dirs``: pass, dir, channel for every channel directory to check, including empty
    ones, which a file scan cannot show.
    ``line_counter(paths)`` returns (path, lines) for a table ``paths(path)``, that of the newest file of each
    directory only; the paths stay distributed. By default a file is read up to the line after ``max_lines``.
    Returns (stale_or_missing: pass, dir, status; empty: pass, dir, lines). The newest file is
    dated by its modification time; a fresh file is checked for emptiness only when its channel is
    not in ``not_empty_checked``. A directory that does not exist cannot be listed, so it is
    reported by ``expected_minus_found`` only, as in the original."""
    day = as_date(as_of)
    latest = latest_eligible_files(facts, suffix=suffix, excludes=excludes)
    per_dir = channel_dirs.join(latest.select("dir", "path", "mtime"), "dir", "left")
    stale = (per_dir.where(F.col("path").isNull() | (F.to_date("mtime") != F.lit(day)))
             .select("pass", "dir", F.when(F.col("path").isNull(), F.lit("missing"))
                     .otherwise(F.lit("stale")).alias("status")))
    fresh = per_dir.where(F.col("path").isNotNull() & (F.to_date("mtime") == F.lit(day))
                          & ~F.col("channel").isin(list(not_empty_checked)))
    from ..sources.files import lines_up_to
    counter = line_counter or (lambda paths: lines_up_to(paths, max_lines + 1))
    counts = counter(fresh.select("path"))
    empty = (fresh.join(counts, "path", "left")
             .where(F.coalesce(F.col("lines"), F.lit(0)) <= F.lit(int(max_lines)))
             .select("pass", "dir", F.coalesce(F.col("lines"), F.lit(0)).cast("bigint").alias("lines")))
    return stale, empty


def landed_file_check(spark: SparkSession, base: str, as_of, *, passes: Sequence[str],
                      channels: Sequence[str], not_empty_checked: Sequence[str],
                      suffix: str = ".csv", excludes: Sequence[str] = (),
                      max_lines: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The daily landed-file check over ``<base>/<pass>/.../<channel>/``.

    Returns (stale_or_missing, empty, status) where ``status`` has one row per pass and report
    kind: ``OK`` or ``NOK`` with the directories joined by newlines."""
    from ..sources.files import list_tree
    facts_all, dirs_all = None, None
    for p in passes:
        files, dirs = list_tree(spark, f"{base.rstrip('/')}/{p}")
        files = files.withColumn("pass", F.lit(p))
        dirs = dirs.withColumn("pass", F.lit(p))
        facts_all = files if facts_all is None else facts_all.unionByName(files)
        dirs_all = dirs if dirs_all is None else dirs_all.unionByName(dirs)
    channel_dirs = (dirs_all.where(F.col("name").isin(list(channels)))
                    .select("pass", "dir", F.col("name").alias("channel")))
    stale, empty = file_reports(facts_all, channel_dirs, as_of, suffix=suffix, excludes=excludes,
                                not_empty_checked=not_empty_checked,
                                max_lines=max_lines)
    pass_df = local_frame(spark, [(p,) for p in passes], "pass string")
    status = (status_rows(stale, pass_df, pass_col="pass", item_col="dir", kind="stale")
              .unionByName(status_rows(empty, pass_df, pass_col="pass", item_col="dir", kind="empty")))
    return stale, empty, status


def fresh_found(facts: DataFrame, as_of, *, suffix: str,
                region_words: Sequence[str], channel_words: Sequence[str]) -> DataFrame:
    """Distinct (region, channel) with at least one file of ``as_of`` or later ending in ``suffix``. A file is
    dated in the session's time zone, here as in ``file_reports``
    (case-insensitive) under a path with a segment naming the region and one naming the channel
    (W4, P10, P12, F14). Segments are matched whole, not by fixed character offsets."""
    from ..functions.text import path_segment_matching
    f = facts.where((F.to_date("mtime") >= F.lit(as_date(as_of)))
                    & F.lower(F.col("name")).endswith(suffix.lower()))
    return (f.select(F.upper(path_segment_matching("path", region_words)).alias("region"),
                     F.upper(path_segment_matching("path", channel_words)).alias("channel"))
            .where((F.col("region") != "") & (F.col("channel") != "")).distinct())


def expected_minus_found_files(spark: SparkSession, root: str, as_of, *, regions: Sequence[str],
                               channels: Sequence[str], suffix: str = ".csv") -> DataFrame:
    """Expected region x channel pairs with no file written since ``as_of`` midnight under
    ``root`` (C4, J8), with the directory text to report (``<root>/<region>/<channel>``)."""
    from ..sources.files import list_tree
    files, _ = list_tree(spark, root)
    found = fresh_found(files, as_of, suffix=suffix, region_words=regions, channel_words=channels)
    expected = expected_pairs(spark, [r.upper() for r in regions], [c.upper() for c in channels],
                              "region", "channel")
    missing = expected_minus_found(expected, found, ["region", "channel"])
    return missing.select("region", "channel",
                          F.concat_ws("/", F.lit(root.rstrip("/")), "region", "channel").alias("path"))
