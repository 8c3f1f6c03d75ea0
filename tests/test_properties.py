"""Formatters against independent Python implementations of the same rules, on random values
(one Spark job per generated batch)."""

from decimal import ROUND_HALF_UP, Decimal

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.functions.readable import clock_text, minutes_2dp, readable_delta, readable_size

UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]
DELTA = [("year", 31_536_000), ("month", 2_635_200), ("day", 86_400), ("hour", 3_600),
         ("minute", 60), ("second", 1)]


def py_size(n: int) -> str:
    x, i = float(n), 0
    while abs(x) >= 1024 and i < len(UNITS) - 1:
        x /= 1024
        i += 1
    # two decimals, ties rounded up on the exact binary value
    return f"{Decimal(x).quantize(Decimal('0.01'), rounding=ROUND_HALF_UP)} {UNITS[i]}"


def py_delta(sec: float) -> str:
    t = int(abs(sec) // 1)
    parts, rest = [], t
    for name, size in DELTA:
        k, rest = divmod(rest, size)
        if k:
            parts.append(f"{k} {name}" + ("" if k == 1 else "s"))
    words = ("0 seconds" if not parts else parts[0] if len(parts) == 1
             else ", ".join(parts[:-1]) + " and " + parts[-1])
    return ("-" if sec <= -1 else "") + words


def py_clock(ms: int) -> str:
    s = (ms // 1000) % 86400
    return f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2 ** 62), st.integers(0, 10 ** 7),
                          st.sampled_from([1023, 1024, 1152, 1536, 400_000, 1024 ** 3 - 1])),
                min_size=1, max_size=60))
def test_readable_size_matches_rule(spark, values):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "n long")
           .select(readable_size("n")).collect()]
    assert got == [py_size(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e9, 1e10, allow_nan=False), st.integers(0, 10 ** 9).map(float)),
                min_size=1, max_size=60))
def test_readable_delta_matches_rule(spark, values):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "s double")
           .select(readable_delta("s")).collect()]
    assert got == [py_delta(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 10 ** 12), min_size=1, max_size=60))
def test_clock_and_minutes_match_rule(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "ms long") \
        .select(clock_text("ms").alias("c"), minutes_2dp("ms").alias("m")).collect()
    assert [r.c for r in rows] == [py_clock(v) for v in values]
    # float rounding of the binary double, ties to even (Python's round does the same)
    assert [r.m for r in rows] == [round(v / 1000 / 60 * 100) / 100 for v in values]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 6), st.integers(0, 12)),
                min_size=1, max_size=40),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 6), st.integers(0, 12)),
                min_size=0, max_size=40))
def test_first_level_removal_matches_brute_force(spark, src, cnt):
    import datetime as dt
    from ledgerline.operators.recon import unmatched_by_second

    def text(t):
        return (dt.datetime(2024, 1, 15, 10) + dt.timedelta(seconds=t)).strftime("%Y-%m-%d %H:%M:%S")

    s_rows = [(i, k, "o", "v", "1", d, text(t)) for i, (k, d, t) in enumerate(src)]
    r_rows = [(k, "o", "v", "1", d, text(t)) for k, d, t in cnt]
    schema = "IMSI string, origToNumber string, service string, recType string, duration int, dateTime string"
    s = spark.createDataFrame(s_rows, "record_id long, " + schema)
    r = spark.createDataFrame(r_rows, schema)
    matched_units = {(k, t) for _, k, _, _, _, d, t in s_rows if k is not None and any(
        rk == k and abs(d - rd) < 3 and abs((dt.datetime.strptime(t, "%Y-%m-%d %H:%M:%S")
                                             - dt.datetime.strptime(rt, "%Y-%m-%d %H:%M:%S")).total_seconds()) < 3
        for rk, _, _, _, rd, rt in r_rows)}
    want = sorted(i for i, k, _, _, _, _, t in s_rows if (k, t) not in matched_units)
    for bc in (False, True):
        got = sorted(x.record_id for x in unmatched_by_second(s, r, broadcast_source=bc).collect())
        assert got == want, bc


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 6),
                          st.integers(-5, 5).map(lambda x: x * 1200)), min_size=1, max_size=40),
       st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 6),
                          st.integers(-5, 5).map(lambda x: x * 1200)), min_size=0, max_size=40),
       st.integers(-3, 3))
def test_key_level_removal_matches_brute_force(spark, src, cnt, jitter):
    from ledgerline.operators.recon import HOUR_SHIFT, unmatched_by_key
    t0 = 1_705_314_030
    s_rows = [(i, k, "o", "v", "1", d, t0 + t) for i, (k, d, t) in enumerate(src)]
    r_rows = [(k, "o", "v", "1", d, t0 + t + jitter) for k, d, t in cnt]
    schema = "IMSI string, origToNumber string, service string, recType string, duration int, timeKey long"
    s = spark.createDataFrame(s_rows, "record_id long, " + schema)
    r = spark.createDataFrame(r_rows, schema)
    keys = {k for _, k, _, _, _, d, t in s_rows if k is not None and any(
        rk == k and abs(d - rd) < 3 and min(abs(t - rt), abs(t - rt + 3600), abs(t - rt - 3600)) < 3
        for rk, _, _, _, rd, rt in r_rows)}
    want = sorted(i for i, k, *_ in s_rows if k not in keys)
    for bc in (False, True):
        got = sorted(x.record_id for x in unmatched_by_key(s, r, tol=HOUR_SHIFT, broadcast_source=bc).collect())
        assert got == want, bc


@pytest.mark.filterwarnings("ignore::FutureWarning")
@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["Msk", "Cnt", None]),
                          st.sampled_from(["CH01", "CH02"]),
                          st.one_of(st.none(), st.integers(-5, 5)), st.integers(-5, 5)),
                min_size=1, max_size=30))
def test_pivot_matches_pandas_pivot_table(spark, rows):
    import datetime as dt
    import pandas as pd
    from ledgerline.operators.pivot import stat_pivot
    days = [dt.date(2024, 1, 13) + dt.timedelta(days=i) for i in range(3)]
    data = [(days[d], r, c, a, b) for d, r, c, a, b in rows]
    sdf = spark.createDataFrame(data, "eventDate date, macroRegion string, cpName string, m1 long, m2 long")
    got = {(r.macroRegion, r.cpName, r.cpType, tuple(r[c] for c in r.__fields__[3:]))
           for r in stat_pivot(sdf, ["m1", "m2"], metric_order=["m1", "m2"]).collect()}

    pdf = pd.DataFrame(data, columns=["eventDate", "macroRegion", "cpName", "m1", "m2"])
    want = set()
    if pdf.dropna(subset=["macroRegion"]).shape[0]:
        pt = pd.pivot_table(pdf, index=["eventDate"], columns=["macroRegion", "cpName"],
                            values=["m1", "m2"], aggfunc="sum", fill_value=0)
        pt = pt.sort_index(ascending=False).transpose().reset_index()
        date_cols = [c for c in pt.columns if isinstance(c, dt.date)]
        for _, rr in pt.iterrows():
            vals = tuple(int(rr[c]) for c in date_cols)
            if sum(vals) != 0:
                want.add((rr["macroRegion"], rr["cpName"], rr["level_0"], vals))
    assert got == want
