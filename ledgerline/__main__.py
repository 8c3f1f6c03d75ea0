"""Command line: one subcommand per daily job, run with ``spark-submit`` or ``python -m ledgerline``.

Inputs are parquet tables (or directories of landed files); results go to partitioned tables or
dated CSV folders. Reports go to CSV folders with ``--out``; without it every row is printed, read from the
cluster one partition at a time. The volume caps of the first-level check cut rows and are off unless
``--caps`` is given. The session comes from the environment
(``SparkSession.builder.getOrCreate()``), so cluster settings are the caller's.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession


def _list(text: str | None) -> list[str]:
    return [x for x in (text or "").split(",") if x]


def _report(df, out: str | None, name: str) -> None:
    """All rows of a report: to a CSV folder, or printed one by one."""
    if out:
        path = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).csv(path)
        print(path)
        return
    print(f"# {name}")
    print("\t".join(df.columns))
    rows = 0
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v).replace("\n", "\\n") for v in row))
        rows += 1
    print(f"# {rows} rows")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="cmd", required=True)

    def day(sp):
        sp.add_argument("--as-of", required=True, type=_dt.date.fromisoformat, help="run day")

    s = sub.add_parser("recon-first", help="first-level check: unmatched per key + second")
    s.add_argument("--source", required=True)
    s.add_argument("--counterpart", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--check", default="CH01")
    s.add_argument("--days-back", type=int, default=3)
    s.add_argument("--cap-trigger", type=int, default=None, help="default: production value")
    s.add_argument("--cap-per-hour", type=int, default=None)
    s.add_argument("--cap-total", type=int, default=None)
    s.add_argument("--caps", action="store_true", help="cut the day's volume as the original job does")
    day(s)

    s = sub.add_parser("recon-key", help="key-level check: unmatched keys, one-hour shift allowed")
    s.add_argument("--source", required=True)
    s.add_argument("--counterpart", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--check", default="Cp06")
    s.add_argument("--lag", type=int, default=3)
    s.add_argument("--lag-sth", type=int, default=3)
    s.add_argument("--concat-key", action="store_true")
    day(s)

    s = sub.add_parser("stat-export", help="statistics pivot and ordered extract as dated CSVs")
    s.add_argument("--stat", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--metrics", default="", help="comma list; default: the metrics present")
    day(s)

    s = sub.add_parser("check-files", help="stale / missing / header-only landed files")
    s.add_argument("--base", required=True)
    s.add_argument("--passes", required=True)
    s.add_argument("--channels", required=True)
    s.add_argument("--not-empty-checked", default="")
    s.add_argument("--excludes", default="SMS,DateTime,DateCharge-Other")
    s.add_argument("--out", default=None, help="folder for the reports")
    day(s)

    s = sub.add_parser("expected-files", help="expected region x channel with no fresh file")
    s.add_argument("--root", required=True)
    s.add_argument("--regions", required=True)
    s.add_argument("--channels", required=True)
    s.add_argument("--out", default=None, help="folder for the report")
    day(s)

    s = sub.add_parser("joblog", help="finished-jobs or running-jobs report")
    s.add_argument("--table", required=True)
    s.add_argument("--running", action="store_true")
    s.add_argument("--user", default=None)
    s.add_argument("--out", default=None, help="folder for the report")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ledgerline-{args.cmd}").getOrCreate()
    from ledgerline.constants import STAT_METRICS
    from ledgerline.functions.datetime import days_before
    from ledgerline.operators import checks, control, joblog, pivot
    from ledgerline.sources import sinks

    if args.cmd == "recon-first":
        given = dict(trigger=args.cap_trigger, per_hour=args.cap_per_hour, total=args.cap_total)
        caps = checks.CapRule(**{k: v for k, v in given.items() if v is not None}) if args.caps else None
        out = checks.first_level_unmatched(spark.read.parquet(args.source),
                                           spark.read.parquet(args.counterpart), args.as_of,
                                           days_back=args.days_back, check=args.check, caps=caps)
        sinks.replace_slices(out, args.out, [{"eventDate": days_before(args.as_of, args.days_back),
                                              "cpName": args.check}])
    elif args.cmd == "recon-key":
        out = checks.key_level_unmatched(spark.read.parquet(args.source),
                                         spark.read.parquet(args.counterpart), args.as_of,
                                         check=args.check, lag=args.lag, lag_sth=args.lag_sth,
                                         concat_key=args.concat_key)
        days = sorted(set(checks.key_level_days(args.as_of, args.lag, args.lag_sth)))
        sinks.replace_slices(out, args.out, [{"eventDate": d, "cpName": args.check} for d in days])
    elif args.cmd == "stat-export":
        stat = spark.read.parquet(args.stat)
        metrics = _list(args.metrics) or [m for m in STAT_METRICS if m in stat.columns]
        check_col = "chName" if "chName" in stat.columns else "cpName"
        print(sinks.export_csv(pivot.stat_pivot(stat, metrics, check_col=check_col), args.out,
                               "pivot-statistics", args.as_of, single_file=True))
        print(sinks.export_csv(pivot.ordered_extract(stat, check_col=check_col, pos_col=None),
                               args.out, "statistics", args.as_of))
    elif args.cmd == "check-files":
        stale, empty, status = control.landed_file_check(
            spark, args.base, args.as_of, passes=_list(args.passes), channels=_list(args.channels),
            not_empty_checked=_list(args.not_empty_checked), excludes=_list(args.excludes))
        _report(stale.orderBy("pass", "dir"), args.out, "stale-or-missing")
        _report(empty.orderBy("pass", "dir"), args.out, "empty")
        _report(status.orderBy("pass", "kind"), args.out, "status")
    elif args.cmd == "expected-files":
        _report(control.expected_minus_found_files(
            spark, args.root, args.as_of, regions=_list(args.regions),
            channels=_list(args.channels)).orderBy("region", "channel"), args.out, "missing")
    elif args.cmd == "joblog":
        log = spark.read.parquet(args.table)
        rep = (joblog.running_jobs(log, user=args.user) if args.running
               else joblog.finished_jobs(log, user=args.user or "airflow"))
        _report(rep, args.out, "running-jobs" if args.running else "finished-jobs")
    return 0


if __name__ == "__main__":
    sys.exit(main())
