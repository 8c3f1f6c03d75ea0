import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from ledgerline.operators import checks
from ledgerline.plans import params as P
from ledgerline.plans.daily import DayConfig, run_day
from ledgerline.sources import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"


def test_run_day_end_to_end_and_rerun(spark, tmp_dir):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    stat = fx.stat_daily(start)
    cfg = DayConfig(dictionary=fx.check_dictionary(spark, P.CHECK_LAGS), regions=P.CONTROL_REGIONS,
                    control_checks=P.CONTROL_CHECKS, pivot_metrics=P.PIVOT_METRICS,
                    caps=checks.CapRule(P.CAP_TRIGGER, P.CAP_PER_HOUR, P.CAP_TOTAL),
                    eligible=F.col("iflag") == 1, not_empty_checked=P.CONTROL_NOT_EMPTY_CHECKED,
                    checked_at=dt.datetime(2024, 1, 18, 5, 0))
    for _ in range(2):   # a rerun must give the same tables
        res = run_day(spark, start=start, rnd=rnd, stat=stat, as_of=P.AS_OF, out_base=tmp_dir, cfg=cfg)
    first = spark.read.parquet(res.first_level_path)
    want = checks.first_level_unmatched(start, rnd, P.AS_OF, days_back=3, caps=cfg.caps)
    assert sorted(r.record_id for r in first.collect()) == sorted(r.record_id for r in want.collect())
    key = spark.read.parquet(res.key_level_path)
    assert key.count() == checks.key_level_unmatched(start, rnd, P.AS_OF).count()
    assert len(glob.glob(os.path.join(res.pivot_csv, "part-*.csv"))) == 1
    assert len(glob.glob(os.path.join(res.extract_csv, "part-*.csv"))) == 1
    assert res.status.count() == 2 * len(P.CONTROL_CHECKS)
    assert {r.checked_at for r in res.status.collect()} == {"18.01.2024 05:00"}


def test_run_day_rerun_with_no_rows_clears_the_slice(spark, tmp_dir):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    stat = fx.stat_daily(start)
    cfg = DayConfig(dictionary=fx.check_dictionary(spark, P.CHECK_LAGS), regions=P.CONTROL_REGIONS,
                    control_checks=P.CONTROL_CHECKS, pivot_metrics=P.PIVOT_METRICS, caps=None)
    res = run_day(spark, start=start, rnd=rnd, stat=stat, as_of=P.AS_OF, out_base=tmp_dir, cfg=cfg)
    assert spark.read.parquet(res.first_level_path).count() > 0
    # the day's source turns out empty on a rerun: its old result slice must not survive
    empty = start.where(F.lit(False))
    res = run_day(spark, start=empty, rnd=rnd, stat=stat, as_of=P.AS_OF, out_base=tmp_dir, cfg=cfg)
    left = glob.glob(os.path.join(res.first_level_path, "eventDate=*", "cpName=*", "*.parquet"))
    assert left == []
