import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.datetime import date_part, epoch_seconds_ntz, lenient_epoch, time_part
from ledgerline.functions.readable import clock_text, minutes_2dp, readable_delta, readable_size
from ledgerline.functions.text import (eligible_file_name, last_component, list_ordinal, list_rank,
                                       matches_any, parent_dir, path_segment_matching,
                                       strip_backslashes)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_readable_size(spark):
    got = _one(spark, [(0,), (1023,), (1024,), (1536,), (10**9,), (None,)], "n long",
               readable_size("n"))
    assert got == ["0.00 B", "1023.00 B", "1.00 KiB", "1.50 KiB", "953.67 MiB", None]


def test_readable_size_large_and_decimal(spark):
    got = _one(spark, [(1024 ** 4,), (5 * 1024 ** 6,)], "n long", readable_size("n"))
    assert got == ["1.00 TiB", "5.00 EiB"]
    from decimal import Decimal
    got = _one(spark, [(Decimal(1536),)], "n decimal(20,0)", readable_size("n"))
    assert got == ["1.50 KiB"]


def test_clock_text_wraps(spark):
    got = _one(spark, [(86_400_000,), (105_500,), (3_723_000,)], "ms long", clock_text("ms"))
    assert got == ["00:00:00", "00:01:45", "01:02:03"]


def test_minutes_float_rounding(spark):
    # 74,700 ms = 1.245 min; the binary double rounds up, decimal-text rounding would give 1.24
    got = _one(spark, [(74_700,), (60_000,), (90_000,)], "ms long", minutes_2dp("ms"))
    assert got == [1.25, 1.0, 1.5]


def test_readable_delta(spark):
    rows = [(100.0,), (12345.0,), (432546534.0,), (0.0,), (1.0,), (3600.0,), (-61.0,), (59.9,), (None,)]
    got = _one(spark, rows, "s double", readable_delta("s"))
    assert got == ["1 minute and 40 seconds", "3 hours, 25 minutes and 45 seconds",
                   "13 years, 8 months, 17 days, 7 hours, 48 minutes and 54 seconds",
                   "0 seconds", "1 second", "1 hour", "-1 minute and 1 second", "59 seconds", None]


def test_lenient_epoch_and_cuts(spark):
    df = spark.createDataFrame([("1970-01-01 00:00:10",), ("bad",), (None,), ("2024-01-15 10:20:30",)],
                               "dt string")
    got = df.select(lenient_epoch("dt").alias("e"), date_part("dt").alias("d"),
                    time_part("dt").alias("t")).collect()
    assert [r.e for r in got] == [10, 0, 0, 1705314030]
    assert got[3].d == "2024-01-15" and got[3].t == "10:20:30"


def test_lenient_epoch_ignores_session_zone(spark):
    df = spark.createDataFrame([("2024-01-15 10:20:30",)], "dt string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Moscow")
        v = df.select(lenient_epoch("dt")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == 1705314030


def test_epoch_seconds_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    assert df.select(epoch_seconds_ntz("ts")).first()[0] == 1704067207


def test_region_rank_unknown_first(spark):
    regions = ["Msk", "Cnt", "Nwe", "Vlg", "Url", "Sth", "Sib", "Fea"]
    df = spark.createDataFrame([("Fea",), ("Zzz",), ("Msk",), (None,)], "r string")
    ordered = [r.r for r in df.orderBy(list_rank("r", regions), F.col("r").asc_nulls_last()).collect()]
    assert ordered == ["Zzz", None, "Msk", "Fea"]


def test_list_ordinal(spark):
    got = _one(spark, [("b",), ("x",)], "m string", list_ordinal("m", ["a", "b"]))
    assert got == ["02", "x"]


def test_path_helpers(spark):
    df = spark.createDataFrame([("/data/A01/x/CH01/file_SMS.csv",), ("Y:\\root\\MSK\\CH02\\a.csv",)],
                               "p string")
    got = df.select(last_component("p").alias("n"), parent_dir("p").alias("d"),
                    path_segment_matching("p", ["MSK", "CNT"]).alias("r"),
                    path_segment_matching("p", ["CH01", "CH02"]).alias("c"),
                    eligible_file_name(last_component("p"), ".csv", ["SMS"]).alias("e"),
                    matches_any("p", ["msk"]).alias("m"),
                    strip_backslashes("p").alias("s")).collect()
    assert got[0].n == "file_SMS.csv" and got[0].d == "/data/A01/x/CH01"
    assert got[0].r == "" and got[0].c == "CH01" and got[0].e is False and got[0].m is False
    assert got[1].n == "a.csv" and got[1].r == "MSK" and got[1].c == "CH02" and got[1].e is True
    assert got[1].m is True and got[1].s == "Y:rootMSKCH02a.csv"


def test_lenient_parse_of_other_forms(spark):
    from ledgerline.functions.datetime import lenient_epoch
    texts = ["2024-01-15 10:00:00", "2024-01-15T10:00:00", "2024-01-15 10:00:00.5", "1705312800",
             "15.01.2024 10:00:00", "2024-01-15 10:00", "2024-01-15T10:00:00.123", "never", None]
    df = spark.createDataFrame([(t,) for t in texts], "dt string")
    assert [r[0] for r in df.select(lenient_epoch("dt")).collect()] == [1705312800] * 7 + [0, 0]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Moscow", "America/New_York"])
def test_lenient_parse_by_shape(spark, zone):
    from ledgerline.functions.datetime import lenient_epoch
    same = ["2024-01-15 10:20:30", "2024-01-15T10:20:30", "15.01.2024 10:20:30", "15.01.2024 10:20:30.5", "1705314030", "1705314030123",
            "2024-01-15 10:20:30Z", "2024-01-15T10:20:30Z", "2024-01-15T13:20:30+03:00", "2024-01-15 13:20:30+0300",
            "2024-01-15 05:20:30.75-05:00", "15 Jan 2024 10:20:30", "15-Jan-2024 10:20:30", "2024-01-15 10:20:30.999999"]
    broken = ["", "bad", "2024-13-15 10:20:30", "2024-01-32 10:20:30", "2024-01-15 25:20:30", "15 Foo 2024 10:20:30",
              "2024-01-15x10:20:30", "2024-01-15T10:20:30x", "99.99.9999 99:99:99", "12345678", "123456789012", " 2024-01-15 10:20:30", None]
    more = [("2024-01-15 10:20", 1705314000), ("2024-01-15T10:20", 1705314000), ("2024-03-31 02:30:00", 1711852200),
            ("2024-03-10 02:30:00", 1710037800), ("1969-12-31 23:59:59.5", -1), ("0001-01-01 00:00:00", -62135596800)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(i, t) for i, t in enumerate([*same, *broken, *[m for m, _ in more]])], "i int, dt string")
        got = [r[0] for r in df.orderBy("i").select(lenient_epoch("dt")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1705314030] * len(same) + [0] * len(broken) + [e for _, e in more]
