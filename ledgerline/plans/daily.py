"""One day of work, end to end: both reconciliations into partitioned result tables, the statistics
pivot and the ordered extract as dated CSV exports, and the completeness reports with their status
rows. Scheduling and sending are left to whatever runs this (a scheduler, a stream trigger)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..constants import FIRST_LEVEL_CHECK, KEY_LEVEL_CHECK, KEY_LEVEL_LAG_DAYS, KEY_LEVEL_LAG_DAYS_STH
from ..functions.datetime import as_date, days_before
from ..operators import checks, control, pivot
from ..sources import sinks


@dataclass
class DayConfig:
    """What a day's run needs besides the tables."""
    dictionary: DataFrame                       # check -> days_before
    regions: Sequence[str]
    control_checks: Sequence[str]
    pivot_metrics: Sequence[str]
    caps: checks.CapRule | None = None            # the volume caps cut rows: opt-in
    key_lag: int = KEY_LEVEL_LAG_DAYS
    key_lag_sth: int = KEY_LEVEL_LAG_DAYS_STH
    pivot_days: Sequence[_dt.date] | None = None
    eligible: Column | None = None               # rows that count as landed for the control
    not_empty_checked: Sequence[str] = ()
    max_rows: int = 1
    checked_at: _dt.datetime | None = None


@dataclass
class DayResult:
    first_level_path: str
    key_level_path: str
    pivot_csv: str
    extract_csv: str
    status: DataFrame


def run_day(spark: SparkSession, *, start: DataFrame, rnd: DataFrame, stat: DataFrame, as_of,
            out_base: str, cfg: DayConfig) -> DayResult:
    """Run the day for ``as_of``. Results are written first; then the slices of the run's days that the new
    result no longer contains are removed, so a rerun that finds nothing leaves nothing behind and a failed
    job keeps the old result."""
    as_of = as_date(as_of)
    base = out_base.rstrip("/")

    lag = checks.lag_for(cfg.dictionary, FIRST_LEVEL_CHECK)
    first = checks.first_level_unmatched(start, rnd, as_of, days_back=lag, caps=cfg.caps)
    first_path = f"{base}/first_level"
    sinks.replace_slices(first, first_path, [{"eventDate": days_before(as_of, lag), "cpName": FIRST_LEVEL_CHECK}])

    key = checks.key_level_unmatched(start, rnd, as_of, lag=cfg.key_lag, lag_sth=cfg.key_lag_sth)
    key_path = f"{base}/key_level"
    key_days = sorted(set(checks.key_level_days(as_of, cfg.key_lag, cfg.key_lag_sth)))
    sinks.replace_slices(key, key_path, [{"eventDate": d, "cpName": KEY_LEVEL_CHECK} for d in key_days])

    # the pivot is bounded (regions x checks x metrics rows): one file, as delivered. The extract is the whole
    # history: sorted part files, in name order
    pivot_csv = sinks.export_csv(pivot.stat_pivot(stat, cfg.pivot_metrics, cfg.pivot_days),
                                 f"{base}/exports", "pivot-statistics", as_of, single_file=True)
    extract = pivot.ordered_extract(stat.withColumnRenamed("cpName", "chName"), pos_col=None)
    extract_csv = sinks.export_csv(extract, f"{base}/exports", "statistics", as_of)

    expected = control.expected_pairs(spark, cfg.regions, cfg.control_checks)
    stale = control.table_freshness(start, expected, as_of, region_col="MR", check_col="cpName",
                                    eligible=cfg.eligible)
    low = control.table_low_volume(start, expected, as_of, region_col="MR", check_col="cpName",
                                   eligible=cfg.eligible, max_rows=cfg.max_rows,
                                   exclude_checks=cfg.not_empty_checked)
    passes = expected.select("check").distinct()
    status = (control.status_rows(stale, passes, pass_col="check", item_col="region", kind="stale",
                                  checked_at=cfg.checked_at)
              .unionByName(control.status_rows(low, passes, pass_col="check", item_col="region",
                                               kind="empty", checked_at=cfg.checked_at)))
    return DayResult(first_path, key_path, pivot_csv, extract_csv, status)
