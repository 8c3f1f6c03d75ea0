import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerline.operators import checks
from ledgerline.sources import fixtures as fx
from ledgerline.streaming.daily import recheck_landed_days

SF_DIR = "/root/testdata/sf0.001"
LAG = 3


def test_stream_rechecks_landed_days_idempotently(spark, tmp_dir):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    days = [dt.date(2024, 1, 14), dt.date(2024, 1, 15)]
    src_path = os.path.join(tmp_dir, "source")
    rnd_path = os.path.join(tmp_dir, "counterpart")
    res_path = os.path.join(tmp_dir, "result")
    start.where(F.col("eventDate") == days[0]).write.partitionBy("eventDate").parquet(src_path)
    rnd.write.parquet(rnd_path)

    def check(day):
        s = spark.read.parquet(src_path)
        r = spark.read.parquet(rnd_path)
        return checks.first_level_unmatched(s, r, day + dt.timedelta(days=LAG), days_back=LAG, caps=None)

    schema = spark.read.parquet(src_path).schema
    ckpt = os.path.join(tmp_dir, "ckpt")
    recheck_landed_days(spark, src_path, schema, check, res_path, checkpoint_location=ckpt)
    # the second day lands later; the stream picks up only the new files
    start.where(F.col("eventDate") == days[1]).write.mode("append").partitionBy("eventDate").parquet(src_path)
    recheck_landed_days(spark, src_path, schema, check, res_path, checkpoint_location=ckpt)
    # a rerun of the same stream changes nothing
    recheck_landed_days(spark, src_path, schema, check, res_path, checkpoint_location=ckpt)

    got = spark.read.parquet(res_path)
    for day in days:
        want = checks.first_level_unmatched(start, rnd, day + dt.timedelta(days=LAG), days_back=LAG, caps=None)
        a = sorted(r.record_id for r in got.where(F.col("eventDate") == day).collect())
        b = sorted(r.record_id for r in want.collect())
        assert a == b and len(a) > 0


def test_stream_rechecks_when_counterpart_lands_later(spark, tmp_dir):
    from ledgerline.streaming.daily import Watched, day_and_neighbours
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    day = dt.date(2024, 1, 15)
    src_path, rnd_path, res_path = (os.path.join(tmp_dir, n) for n in ("src", "rnd", "res"))
    start.where(F.col("eventDate") == day).write.partitionBy("eventDate").parquet(src_path)
    # the counterpart lands in two parts; the first holds nothing for the checked day
    rnd.where(F.col("eventDate") == day - dt.timedelta(days=5)).write.partitionBy("eventDate").parquet(rnd_path)

    def check(d):
        s = spark.read.parquet(src_path)
        r = spark.read.parquet(rnd_path)
        return checks.first_level_unmatched(s, r, d + dt.timedelta(days=LAG), days_back=LAG, caps=None)

    src_schema = spark.read.parquet(src_path).schema
    rnd_schema = spark.read.parquet(rnd_path).schema
    ckpt = os.path.join(tmp_dir, "ckpt2")
    watch = [Watched(rnd_path, rnd_schema, affects=day_and_neighbours)]
    recheck_landed_days(spark, src_path, src_schema, check, res_path, watch=watch, checkpoint_location=ckpt)
    before = spark.read.parquet(res_path).where(F.col("eventDate") == day).count()
    assert before == start.where((F.col("eventDate") == day) & (F.col("cpName") == "CH01")
                                 & (F.col("iflag") == 0)).select(*[c for c in start.columns]).distinct().count()
    # the counterpart of the day lands: the day is re-checked without any new source file
    rnd.where(F.col("eventDate") == day).write.mode("append").partitionBy("eventDate").parquet(rnd_path)
    recheck_landed_days(spark, src_path, src_schema, check, res_path, watch=watch, checkpoint_location=ckpt)
    got = sorted(r.record_id for r in spark.read.parquet(res_path).where(F.col("eventDate") == day).collect())
    want = sorted(r.record_id for r in checks.first_level_unmatched(
        start, rnd, day + dt.timedelta(days=LAG), days_back=LAG, caps=None).collect())
    assert got == want and len(got) < before


def test_stream_empty_recheck_clears_the_old_slice(spark, tmp_dir):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    day = dt.date(2024, 1, 15)
    src_path, res_path, ckpt = (os.path.join(tmp_dir, n) for n in ("src3", "res3", "ckpt3"))
    start.where(F.col("eventDate") == day).write.partitionBy("eventDate").parquet(src_path)
    schema = spark.read.parquet(src_path).schema
    other = start.where((F.col("eventDate") == day - dt.timedelta(days=1))).limit(3)
    other.write.partitionBy("eventDate", "cpName").parquet(res_path)

    def full(d):
        return checks.first_level_unmatched(spark.read.parquet(src_path), rnd, d + dt.timedelta(days=LAG), days_back=LAG)

    recheck_landed_days(spark, src_path, schema, full, res_path, checkpoint_location=ckpt)
    assert spark.read.parquet(res_path).where(F.col("eventDate") == day).count() > 0
    start.where(F.col("eventDate") == day).limit(1).write.mode("append").partitionBy("eventDate").parquet(src_path)
    recheck_landed_days(spark, src_path, schema, lambda d: full(d).where(F.lit(False)), res_path, checkpoint_location=ckpt)
    left = spark.read.parquet(res_path)
    assert left.where(F.col("eventDate") == day).count() == 0 and left.count() == 3
