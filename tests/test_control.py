import datetime as dt
import os
import time

from ledgerline.operators import control

DAY = dt.date(2024, 1, 15)


def test_table_forms(spark):
    rows = [("Msk", "CH01", DAY, 1), ("Msk", "CH01", DAY, 1), ("Cnt", "CH01", DAY - dt.timedelta(days=2), 1),
            ("Msk", "CH02", DAY, 1), ("Cnt", "CH02", DAY, 0), (None, "CH02", DAY, 1)]
    data = spark.createDataFrame(rows, "MR string, cpName string, eventDate date, iflag int")
    expected = control.expected_pairs(spark, ["Msk", "Cnt"], ["CH01", "CH02"])
    elig = data.iflag == 1
    found = control.landed_pairs(data, DAY, region_col="MR", check_col="cpName", eligible=elig)
    gap = {tuple(r) for r in control.expected_minus_found(expected, found, ["region", "check"]).collect()}
    assert gap == {("Cnt", "CH01"), ("Cnt", "CH02")}
    stale = {(r.region, r.check, r.status) for r in control.table_freshness(
        data, expected, DAY, region_col="MR", check_col="cpName", eligible=elig).collect()}
    assert stale == {("Cnt", "CH01", "stale"), ("Cnt", "CH02", "missing")}
    low = {(r.region, r.check, r.rows) for r in control.table_low_volume(
        data, expected, DAY, region_col="MR", check_col="cpName", eligible=elig, max_rows=1).collect()}
    assert low == {("Msk", "CH02", 1)}
    low2 = control.table_low_volume(data, expected, DAY, region_col="MR", check_col="cpName",
                                    eligible=elig, max_rows=1, exclude_checks=["CH02"]).count()
    assert low2 == 0
    passes = spark.createDataFrame([("CH01",), ("CH02",), ("CH03",)], "check string")
    report = control.table_freshness(data, expected, DAY, region_col="MR", check_col="cpName", eligible=elig)
    st = {r.check: (r.status, r["items"]) for r in control.status_rows(
        report, passes, pass_col="check", item_col="region", kind="stale").collect()}
    assert st == {"CH01": ("NOK", "Cnt"), "CH02": ("NOK", "Cnt"), "CH03": ("OK", "")}


def _write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_landed_file_check(spark, tmp_dir):
    today = dt.date.today()
    yesterday = time.time() - 2 * 86400
    base = os.path.join(tmp_dir, "out")
    _write(f"{base}/A01/x/CH01/a.csv", "")                                  # zero bytes -> empty
    _write(f"{base}/A01/x/CH02/a.csv", "h1;h2\n")                           # header only -> empty
    _write(f"{base}/A01/x/CH03/a b.csv", "h1;h2\n1;2\n")                    # fine (space in name)
    _write(f"{base}/A01/x/CH04/a.csv", "h1;h2\n1;2\n", mtime=yesterday)     # stale
    _write(f"{base}/A01/x/CH05/b_SMS.csv", "h\n1\n")                        # ignored -> missing
    os.makedirs(f"{base}/A01/y/CH01", exist_ok=True)                         # empty dir -> missing
    _write(f"{base}/A02/CH02/a.csv", "h\n", mtime=yesterday)                # stale, no count needed
    _write(f"{base}/A02/CH02/new.txt", "x")                                 # not csv
    stale, empty, status = control.landed_file_check(
        spark, base, today, passes=["A01", "A02"], channels=["CH01", "CH02", "CH03", "CH04", "CH05"],
        not_empty_checked=["CH05"], excludes=["SMS", "DateTime", "DateCharge-Other"])

    def tail(p):
        return p.split("/out/", 1)[1]

    got_stale = {(r["pass"], tail(r.dir), r.status) for r in stale.collect()}
    assert got_stale == {("A01", "A01/x/CH04", "stale"), ("A01", "A01/x/CH05", "missing"),
                         ("A01", "A01/y/CH01", "missing"), ("A02", "A02/CH02", "stale")}
    got_empty = {(r["pass"], tail(r.dir), r.lines) for r in empty.collect()}
    assert got_empty == {("A01", "A01/x/CH01", 0), ("A01", "A01/x/CH02", 1)}
    st = {(r["pass"], r.kind): r.status for r in status.collect()}
    assert st == {("A01", "stale"): "NOK", ("A01", "empty"): "NOK",
                  ("A02", "stale"): "NOK", ("A02", "empty"): "OK"}


def test_expected_minus_found_files(spark, tmp_dir):
    today = dt.date.today()
    old = time.time() - 3 * 86400
    root = os.path.join(tmp_dir, "landing")
    _write(f"{root}/MSK/CH01/a.csv", "h\n1\n")
    _write(f"{root}/MSK/CH02/a.csv", "h\n1\n", mtime=old)    # not fresh
    _write(f"{root}/cnt/ch01/sub/b.CSV", "h\n")               # case-insensitive names
    _write(f"{root}/CNT/CH02/c.txt", "h\n")                   # not csv
    got = {(r.region, r.channel) for r in control.expected_minus_found_files(
        spark, root, today, regions=["MSK", "CNT", "STH"], channels=["CH01", "CH02"]).collect()}
    assert got == {("MSK", "CH02"), ("CNT", "CH02"), ("STH", "CH01"), ("STH", "CH02")}


def test_freshness_looks_back_only_for_absent_pairs(spark):
    rows = [("Msk", "CH01", DAY - dt.timedelta(days=400), 1), ("Cnt", "CH01", DAY - dt.timedelta(days=1), 1),
            ("Cnt", "CH01", DAY - dt.timedelta(days=3), 1), ("Sib", "CH01", DAY, 1), ("Sib", "CH01", DAY - dt.timedelta(days=1), 1)]
    data = spark.createDataFrame(rows, "MR string, cpName string, eventDate date, iflag int")
    expected = control.expected_pairs(spark, ["Msk", "Cnt", "Sib", "Fea"], ["CH01"])
    got = {(r.region, r.status, r.last_date) for r in control.table_freshness(
        data, expected, DAY, region_col="MR", check_col="cpName").collect()}
    assert got == {("Msk", "stale", DAY - dt.timedelta(days=400)), ("Cnt", "stale", DAY - dt.timedelta(days=1)),
                   ("Fea", "missing", None)}
    full = control.expected_pairs(spark, ["Sib"], ["CH01"])
    assert control.table_freshness(data, full, DAY, region_col="MR", check_col="cpName").count() == 0


def test_one_midnight_in_another_driver_zone(spark, tmp_dir):
    """A file is dated in the session's zone by both file reports, whatever the driver's zone."""
    root = os.path.join(tmp_dir, "zone")
    late = dt.datetime(2024, 1, 14, 22, 30, tzinfo=dt.timezone.utc).timestamp()
    _write(f"{root}/A01/MSK/CH01/a.csv", "h\n1\n", mtime=late)
    before = os.environ.get("TZ")
    os.environ["TZ"] = "Europe/Moscow"
    time.tzset()
    try:
        stale, _, _ = control.landed_file_check(spark, root, DAY, passes=["A01"], channels=["CH01"], not_empty_checked=[])
        assert [r.status for r in stale.collect()] == ["stale"]
        gap = control.expected_minus_found_files(spark, root, DAY, regions=["MSK"], channels=["CH01"]).collect()
        assert len(gap) == 1
    finally:
        if before is None:
            del os.environ["TZ"]
        else:
            os.environ["TZ"] = before
        time.tzset()


def test_local_frame_values(spark):
    from ledgerline.sources.tables import local_frame
    df = local_frame(spark, [("it's", 1, 2.5, DAY, None), ("a\\b", -3, 0.0, None, "x")],
                     "s string, i int, f double, d date, n string")
    assert [tuple(r) for r in df.collect()] == [("it's", 1, 2.5, DAY, None), ("a\\b", -3, 0.0, None, "x")]
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "int", "double", "date", "string"]
