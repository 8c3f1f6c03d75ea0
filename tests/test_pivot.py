import datetime as dt

from ledgerline.operators.pivot import ordered_extract, stat_pivot

D1, D2, D3 = dt.date(2024, 1, 13), dt.date(2024, 1, 14), dt.date(2024, 1, 15)
SCHEMA = "eventDate date, macroRegion string, cpName string, firstStream long, firstDlt long"


def test_pivot_cancel_null_and_order(spark):
    rows = [
        (D1, "Msk", "CH01", 1, 5),
        (D2, "Msk", "CH01", 2, -5),     # firstDlt cancels over the days -> row removed
        (D3, "Cnt", "CH01", None, 0),   # NULL metric counts 0 -> both metric rows all zero, removed
        (D3, None, "CH01", 9, 9),       # NULL region drops out
        (D3, "Cnt", "CH02", 4, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = stat_pivot(df, ["firstStream", "firstDlt"], [D1, D2, D3])
    assert out.columns == ["macroRegion", "cpName", "cpType", "2024-01-15", "2024-01-14", "2024-01-13"]
    got = [tuple(r) for r in out.collect()]
    assert got == [("Cnt", "CH02", "firstStream", 4, 0, 0),
                   ("Cnt", "CH02", "firstDlt", 1, 0, 0),
                   ("Msk", "CH01", "firstStream", 0, 2, 1)]


def test_pivot_dates_from_data(spark):
    df = spark.createDataFrame([(D1, "Msk", "CH01", 1, 1), (D3, "Msk", "CH01", 2, 0)], SCHEMA)
    out = stat_pivot(df, ["firstStream"])
    assert out.columns[3:] == ["2024-01-15", "2024-01-13"]


def test_ordered_extract_positions(spark):
    rows = [(D1, "Fea", "CH01", 1, 0), (D2, "Msk", "CH01", 1, 0), (D3, "Msk", "CH01", 1, 0),
            (D3, "Xyz", "CH01", 1, 0), (D1, "Msk", "CH00", 1, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("cpName", "chName")
    out = ordered_extract(df.repartition(3), check_col="chName").collect()
    assert [r.pos for r in out] == [1, 2, 3, 4, 5]
    assert [(r.chName, r.macroRegion, r.eventDate) for r in out] == [
        ("CH00", "Msk", D1), ("CH01", "Xyz", D3), ("CH01", "Msk", D3), ("CH01", "Msk", D2),
        ("CH01", "Fea", D1)]


def test_with_position_property(spark):
    import random
    from pyspark.sql import functions as F
    from ledgerline.operators.position import with_position
    rng = random.Random(5)
    rows = [(rng.randint(0, 50), rng.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b double, id long").repartition(9)
    out = with_position(df, [F.col("a").desc(), "b", "id"]).collect()
    assert [r.pos for r in out] == list(range(1, 3001))
    want = [r[2] for r in sorted(rows, key=lambda r: (-r[0], r[1], r[2]))]
    assert [r.id for r in out] == want


def test_empty_inputs(spark):
    from ledgerline.operators.position import with_position
    empty = spark.createDataFrame([], SCHEMA)
    out = stat_pivot(empty, ["firstStream"])
    assert out.count() == 0 and out.columns[:3] == ["macroRegion", "cpName", "cpType"]
    assert with_position(empty, ["eventDate"]).count() == 0


def test_decimal_metrics_stay_exact(spark):
    import datetime as dt
    from decimal import Decimal
    from ledgerline.operators.pivot import stat_pivot
    d = dt.date(2024, 1, 15)
    df = spark.createDataFrame([(d, "Msk", "CH01", 9_007_199_254_740_993, Decimal("0.10")),
                                (d, "Msk", "CH01", 0, Decimal("0.20"))],
                               "eventDate date, macroRegion string, cpName string, firstStream long, dsc decimal(10,2)")
    out = {r.cpType: r[str(d)] for r in stat_pivot(df, ["firstStream", "dsc"], [d]).collect()}
    assert out == {"firstStream": Decimal("9007199254740993.00"), "dsc": Decimal("0.30")}


def test_pivot_equals_brute_force_over_many_dates(spark):
    """A thousand dates with gaps: the statistics are read once and the plan has no branch for each date."""
    import random
    rng = random.Random(6)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=3 * i) for i in range(1000)]
    rows = [(rng.choice(days), rng.choice(["Msk", "Cnt"]), f"CH{rng.randint(1, 3)}", rng.randint(-3, 3), None) for _ in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sums = {}
    for d, region, check, v, _ in rows:
        sums.setdefault((region, check), {}).setdefault(str(d), []).append(v)
    out = stat_pivot(df, ["firstStream", "firstDlt"])
    assert out.columns[3:] == sorted({str(r[0]) for r in rows}, reverse=True)
    got = {(r[0], r[1], r[2]): tuple(r)[3:] for r in out.collect()}
    want = {(*k, "firstStream"): tuple(sum(by.get(d, [0])) for d in out.columns[3:]) for k, by in sums.items()}
    assert got == {k: v for k, v in want.items() if sum(v)}
    p = stat_pivot(df, ["firstStream"], days, sort=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in p and sum("ExistingRDD" in ln or "LogicalRDD" in ln for ln in p.splitlines()) == 1
