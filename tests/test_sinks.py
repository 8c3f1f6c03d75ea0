import datetime as dt
import glob
import gzip
import os

from ledgerline.sources.sinks import clear_slices, export_csv, write_partitions

D1, D2 = dt.date(2024, 1, 15), dt.date(2024, 1, 16)


def test_partition_overwrite_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "result")
    day1 = spark.createDataFrame([(D1, "CH01", 1), (D1, "CH01", 2), (D1, "Cp06", 3)],
                                 "eventDate date, cpName string, v int")
    write_partitions(day1, path)
    write_partitions(day1, path)                       # rerun replaces, does not append
    assert spark.read.parquet(path).count() == 3
    day2 = spark.createDataFrame([(D2, "CH01", 4)], "eventDate date, cpName string, v int")
    write_partitions(day2, path)                       # other slice untouched
    assert spark.read.parquet(path).count() == 4
    redo = spark.createDataFrame([(D1, "CH01", 9)], "eventDate date, cpName string, v int")
    write_partitions(redo, path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [3, 4, 9]
    assert clear_slices(spark, path, [{"eventDate": D1, "cpName": "Cp06"}]) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [4, 9]


def test_export_csv_cp1251_quoted(spark, tmp_dir):
    df = spark.createDataFrame([("Юг", 5, dt.datetime(2024, 1, 15, 10, 20, 30)), (None, 6, None)],
                               "name string, n int, ts timestamp")
    out = export_csv(df.orderBy("n"), tmp_dir, "statistics", D1, single_file=True)
    assert out.endswith("statistics/export_date=2024-01-15")
    (part,) = glob.glob(os.path.join(out, "part-*.csv"))
    text = open(part, "rb").read().decode("cp1251")
    lines = text.splitlines()
    assert lines[0] == '"name";"n";"ts"'
    assert lines[1] == '"Юг";"5";"2024-01-15 10:20:30"'
    out2 = export_csv(df, tmp_dir, "statistics_gz", D1, compression="gzip", single_file=True)
    (gz,) = glob.glob(os.path.join(out2, "part-*.csv.gz"))
    assert gzip.open(gz).read().decode("cp1251").splitlines()[0] == '"name";"n";"ts"'
