import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.operators.caps import (CapPlan, apply_caps, cap_decision, limit_by, limit_total,
                                       RANK_COL)

SCHEMA = "record_id long, eventDateTime timestamp_ntz, v long"


def _rows(n, seed=1):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 15)
    return [(i, base + dt.timedelta(seconds=rng.randint(0, 86399)), rng.randint(0, 9)) for i in range(n)]


def _brute_top(rows, n):
    by_hour = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        by_hour.setdefault(r[1].hour, []).append(r)
    return {r[0] for h in by_hour.values() for r in h[:n]}


def test_limit_by_equals_brute_force(spark):
    rows = _rows(2000)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("h", F.hour("eventDateTime"))
    for fanout in (0, 4, 32):
        got = {r.record_id for r in limit_by(df, ["h"], ["eventDateTime", "record_id"], 7,
                                             fanout=fanout).collect()}
        assert got == _brute_top(rows, 7)


def test_limit_by_hot_group(spark):
    # one hour holds most of the rows: the salted first level still gives the exact top n
    base = dt.datetime(2024, 1, 15, 3)
    rows = [(i, base + dt.timedelta(milliseconds=i * 7 % 3_600_000), 0) for i in range(5000)]
    rows += _rows(300, seed=5)
    rows = [(i, t, v) for i, (_, t, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("h", F.hour("eventDateTime"))
    got = {r.record_id for r in limit_by(df, ["h"], ["eventDateTime", "record_id"], 11, fanout=16).collect()}
    assert got == _brute_top(rows, 11)


def test_limit_total_exact(spark):
    rows = _rows(800, seed=2)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("h", F.hour("eventDateTime"))
    ranked = limit_by(df, ["h"], ["eventDateTime", "record_id"], 5, keep_rank=True)
    got = {r.record_id for r in limit_total(ranked, "h", 37).collect()}
    capped = sorted((r for r in rows if r[0] in _brute_top(rows, 5)), key=lambda r: (r[1].hour, r[1], r[0]))
    assert got == {r[0] for r in capped[:37]}
    assert limit_total(ranked, "h", 10_000).count() == len(capped)


def test_cap_decision_and_apply(spark):
    df = spark.createDataFrame(_rows(500, seed=3), SCHEMA)
    off = cap_decision(df, trigger=501, per_group=5, total=100)
    assert not off.on and off.day_rows == 500
    assert apply_caps(df, off).count() == 500
    on = cap_decision(df, trigger=500, per_group=5, total=100)
    assert on == CapPlan(500, 5, 100)
    out = apply_caps(df, on)
    assert out.count() == 100 and RANK_COL not in out.columns


def test_caps_never_raise_count_and_ignore_input_partitioning(spark):
    rows = _rows(1500, seed=4)
    plan = CapPlan(1500, 9, 150)
    a = {r.record_id for r in apply_caps(spark.createDataFrame(rows, SCHEMA), plan).collect()}
    shuffled = rows[:]
    random.Random(9).shuffle(shuffled)
    b = {r.record_id for r in apply_caps(spark.createDataFrame(shuffled, SCHEMA).repartition(7), plan).collect()}
    assert a == b and len(a) <= 150


def test_mark_capped(spark):
    from ledgerline.operators.caps import mark_capped, mark_capped_sql
    df = spark.createDataFrame([("f.csv",)], "inputFileName string")
    on, off = CapPlan(10, 5, 100), CapPlan(1, None, None)
    assert df.select(mark_capped("inputFileName", on)).first()[0] == "!f.csv"
    assert df.select(mark_capped("inputFileName", off)).first()[0] == "f.csv"
    assert df.selectExpr(mark_capped_sql("inputFileName", on)).first()[0] == "!f.csv"


def test_limit_total_boundaries_and_null_hour(spark):
    rows = _rows(400, seed=8) + [(10_000 + i, None, 0) for i in range(3)]   # NULL times sort first
    df = spark.createDataFrame(rows, SCHEMA).withColumn("h", F.hour("eventDateTime"))
    ranked = limit_by(df, ["h"], ["eventDateTime", "record_id"], 4, keep_rank=True).cache()
    per_hour = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[0])):
        per_hour.setdefault(None if r[1] is None else r[1].hour, []).append(r)
    capped = [r for h in sorted(per_hour, key=lambda h: (h is not None, h or 0)) for r in per_hour[h][:4]]
    first_group = len(per_hour[None][:4])
    for total in (0, first_group, first_group + 1, 17, len(capped) - 1, len(capped), len(capped) + 5):
        got = {r.record_id for r in limit_total(ranked, "h", total).collect()}
        assert got == {r[0] for r in capped[:total]}, total


def test_cut_by_hour_equals_brute_force_with_hot_second_and_null(spark):
    from ledgerline.operators.caps import cut_by_hour
    hot = dt.datetime(2024, 1, 15, 7, 30, 1)
    rows = _rows(900, seed=11) + [(20_000 + i, hot + dt.timedelta(microseconds=i % 97), 0) for i in range(700)]
    rows += [(30_000 + i, None, 0) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    per_hour = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[0])):
        per_hour.setdefault(None if r[1] is None else r[1].hour, []).append(r)
    for n, total in ((1, None), (5, None), (300, None), (5, 37), (5, 0), (300, 711), (10_000, None), (10_000, 1200)):
        want = [r[0] for h in sorted(per_hour, key=lambda h: (h is not None, h or 0)) for r in per_hour[h][:n]][:total]
        got = [r.record_id for r in cut_by_hour(df, n, total=total).collect()]
        assert sorted(got) == sorted(want), (n, total)


def test_no_cap_unless_asked_for(spark):
    """A day above the trigger keeps every unmatched row by default."""
    from ledgerline.operators import checks
    from ledgerline.sources import fixtures as fx
    ev = fx.load_events(spark, "/root/testdata/sf0.001")
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    got = checks.first_level_unmatched(start, rnd, "2024-01-18", days_back=3)
    none = rnd.where("FALSE")
    assert checks.first_level_unmatched(start, none, "2024-01-18", days_back=3).count() == \
        checks.first_level_source(start, dt.date(2024, 1, 15)).select("record_id").distinct().count()
    assert not [r for r in got.collect() if r.inputFileName.startswith("!")]


def test_long_user_ids_keep_their_digits(spark):
    from ledgerline.sources import fixtures as fx
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 15), u, "a", 1.0, "{}") for u in (7, 1_234_567, 1_234_568)],
                               "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    assert [r.IMSI for r in fx.cdr_base(df).collect()] == ["25099000007", "250991234567", "250991234568"]
