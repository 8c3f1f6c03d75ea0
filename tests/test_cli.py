import datetime as dt
import glob
import os

from ledgerline.__main__ import main
from ledgerline.operators import checks, joblog
from ledgerline.sources import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"


def test_cli_jobs(spark, tmp_dir, capsys):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    src, cnt, stat, log = (os.path.join(tmp_dir, n) for n in ("src", "cnt", "stat", "log"))
    start.write.parquet(src)
    rnd.write.parquet(cnt)
    fx.stat_daily(start).write.parquet(stat)
    fx.job_log(ev).write.parquet(log)

    out1 = os.path.join(tmp_dir, "first")
    assert main(["recon-first", "--source", src, "--counterpart", cnt, "--out", out1,
                 "--as-of", "2024-01-18"]) == 0
    want = checks.first_level_unmatched(start, rnd, dt.date(2024, 1, 18), days_back=3, caps=None)
    assert sorted(r.record_id for r in spark.read.parquet(out1).collect()) == \
        sorted(r.record_id for r in want.collect())

    out2 = os.path.join(tmp_dir, "key")
    assert main(["recon-key", "--source", src, "--counterpart", cnt, "--out", out2,
                 "--as-of", "2024-01-18"]) == 0
    assert spark.read.parquet(out2).count() == checks.key_level_unmatched(start, rnd, "2024-01-18").count()

    exp = os.path.join(tmp_dir, "exports")
    assert main(["stat-export", "--stat", stat, "--out", exp, "--as-of", "2024-01-18"]) == 0
    assert len(glob.glob(os.path.join(exp, "*", "export_date=2024-01-18", "part-*.csv"))) == 2

    capsys.readouterr()
    assert main(["joblog", "--table", log]) == 0
    printed = capsys.readouterr().out
    rows = joblog.finished_jobs(fx.job_log(ev)).count()
    assert "query_duration_min" in printed and rows > 20
    assert len(printed.splitlines()) == rows + 3 and f"# {rows} rows" in printed     # every row, no cut
    assert main(["joblog", "--table", log, "--out", os.path.join(tmp_dir, "rep")]) == 0
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "rep", "finished-jobs")).count() == rows


def test_cli_rerun_of_an_emptied_day_clears_its_slice(spark, tmp_dir):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    for i, (cmd, src) in enumerate([("recon-first", start), ("recon-key", start)]):
        full, none, cnt, out = (os.path.join(tmp_dir, f"{n}{i}") for n in ("full", "none", "cnt", "out"))
        src.write.parquet(full)
        src.where("FALSE").write.parquet(none)
        rnd.write.parquet(cnt)
        args = ["--counterpart", cnt, "--out", out, "--as-of", "2024-01-18"]
        assert main([cmd, "--source", full, *args]) == 0
        assert spark.read.parquet(out).count() > 0
        assert main([cmd, "--source", none, *args]) == 0
        assert glob.glob(os.path.join(out, "eventDate=*", "cpName=*", "*.parquet")) == []


def test_cli_reports_every_file_finding(spark, tmp_dir, capsys):
    base = os.path.join(tmp_dir, "landed")
    for i in range(30):
        os.makedirs(os.path.join(base, "A01", f"x{i}", "CH01"))
    assert main(["check-files", "--base", base, "--passes", "A01", "--channels", "CH01", "--as-of", "2024-01-18"]) == 0
    printed = capsys.readouterr().out
    assert printed.count("missing") >= 30 and "# 30 rows" in printed
