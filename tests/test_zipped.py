import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.zipped import export_zip, read_zip

ROWS = [("a;b", 'say "x"', None), ("", "line\nbreak", "2"), ("Привет", "€", "3"), (None, None, None)]


def zips(folder):
    return sorted(f for _, _, names in os.walk(folder) for f in names if f.endswith(".zip"))


def test_round_trip_of_odd_fields(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "`my col` string, `a;b` string, n string").repartition(3)
    out = export_zip(df, str(tmp_path), "report", "2024-01-18")
    assert out.endswith("report/export_date=2024-01-18")
    back = read_zip(spark, out)
    assert back.columns == ["my col", "a;b", "n"]
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == sorted(map(str, ROWS))
    again = export_zip(df.limit(1), str(tmp_path), "report", "2024-01-18")
    assert read_zip(spark, again).count() == 1 and not [d for d in os.listdir(out) if d.startswith("_")]


def test_bytes_are_those_of_the_csv_export(spark, tmp_path):
    df = spark.sql("SELECT 1 AS n, TIMESTAMP_NTZ'2024-01-15 07:00:00.5' AS t, DATE'2024-01-15' AS d, CAST(NULL AS STRING) AS x, 'ы中' AS s")
    out = export_zip(df, str(tmp_path), "r", "2024-01-18", single_file=True)
    (name,) = zips(out)
    with zipfile.ZipFile(f"{out}/{name}") as z:
        assert z.testzip() is None
        text = z.read(z.namelist()[0]).decode("windows-1251")
    assert text == '"n";"t";"d";"x";"s"\n"1";"2024-01-15 07:00:00";"2024-01-15";;"ы?"\n'


def test_empty_export_has_a_header_and_single_nulls_stay(spark, tmp_path):
    df = spark.createDataFrame([], "a string, b int")
    out = export_zip(df, str(tmp_path), "none", "2024-01-18")
    assert read_zip(spark, out).columns == ["a", "b"] and read_zip(spark, out).count() == 0
    one = spark.createDataFrame([(None,), ("x",), ("",)], "a string")
    assert sorted(map(str, (r.a for r in read_zip(spark, export_zip(one, str(tmp_path), "one", "2024-01-18")).collect()))) == ["", "None", "x"]
    with pytest.raises(Exception, match="no zip export"):
        read_zip(spark, str(tmp_path / "absent"))


def test_aborted_job_leaves_the_old_export_and_no_file(spark, tmp_path):
    good = spark.range(100).selectExpr("cast(id AS string) AS a").repartition(4)
    out = export_zip(good, str(tmp_path), "r", "2024-01-18")
    before = zips(out)
    bad = spark.range(0, 4000, 1, 4).select(F.expr("if(id = 3900, raise_error('lost'), cast(id AS string))").alias("a"))
    with pytest.raises(Exception, match="lost"):
        export_zip(bad, str(tmp_path), "r", "2024-01-18")
    assert zips(out) == before and not [d for d in os.listdir(out) if d.startswith("_")]
    assert read_zip(spark, out).count() == 100


def test_columns_have_to_be_text(spark, tmp_path):
    export_zip(spark.range(1), str(tmp_path), "r", "2024-01-18")
    with pytest.raises(Exception, match="format these first: id"):
        spark.range(1).write.format("zip_csv").mode("append").save(str(tmp_path / "x"))
