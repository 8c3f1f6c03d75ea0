import datetime as dt
import random

import pytest

from ledgerline.operators import thresholds
from ledgerline.operators.thresholds import first_n

SCHEMA = "g string, t timestamp_ntz, id long"


def brute(rows, n):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[2])):
        groups.setdefault(r[0], []).append(r)
    return sorted((r for g in groups.values() for r in g[:n]), key=str)


def got(df, n, **options):
    return sorted((tuple(r) for r in first_n(df, ["g"], ["t", "id"], n, **options).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng, day = random.Random(3), dt.datetime(2024, 3, 31)
    rows = [(rng.choice(["a", "b", None]), day + dt.timedelta(microseconds=rng.randrange(86_400_000_000)), i) for i in range(600)]
    rows += [("hot", day + dt.timedelta(seconds=rng.randrange(30)), 1000 + i) for i in range(900)]     # many equal times
    rows += [("one", day, 3000 + i) for i in range(200)]                                               # a single time
    rows += [("null", None if i % 2 else day, 4000 + i) for i in range(100)]
    rows += [("copy", day, 5000)] * 50                                                                 # equal rows
    rows += [("wide", dt.datetime(1, 1, 1), 6000), ("wide", dt.datetime(9999, 12, 31), 6001)]
    return rows


@pytest.mark.parametrize("n", [1, 7, 31, 200, 899, 900, 10_000])
def test_equals_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df, n) == brute(rows, n)


def test_shuffled_cuts_and_few_slots(spark, rows, monkeypatch):
    monkeypatch.setattr(thresholds, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(thresholds, "SLOTS", 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for n in (3, 150):
        assert got(df, n, fanout=3) == brute(rows, n)


def test_longs_of_any_range_dates_and_names(spark):
    big = (1 << 63) - 1
    rows = [("a", v, i) for i, v in enumerate([big, -big - 1, None, 0, 1, -1, big - 1, -big, big])]
    df = spark.createDataFrame(rows, "_key string, _salt long, `my col` long")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    for n in range(1, 10):
        out = first_n(df, ["_key"], ["_salt", "my col"], n)
        assert out.columns == df.columns
        assert sorted(r[2] for r in out.collect()) == sorted(r[2] for r in want[:n])
    days = spark.sql("SELECT 1 AS g, date_add(DATE'2024-01-01', CAST(id AS INT)) AS d FROM range(9)")
    assert [str(r.d) for r in first_n(days, ["g"], ["d"], 2).orderBy("d").collect()] == ["2024-01-01", "2024-01-02"]
    with pytest.raises(TypeError):
        first_n(df, ["my col"], ["_key"], 1)


def test_empty_and_none(spark, rows):
    df = spark.createDataFrame(rows[:20], SCHEMA)
    assert first_n(df, ["g"], ["t", "id"], 0).count() == 0
    assert first_n(df.where("false"), ["g"], ["t", "id"], 3).count() == 0


def test_production_limit_orders_only_the_cut(spark):
    """At 10,000 rows a group no window sees rows away from the cut, and the rows stay where they were read."""
    df = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 500 AS string) END AS g",
                                        "TIMESTAMP_NTZ'2024-01-15 00:00:00' + make_dt_interval(0, 0, 0, id % 40000) AS t", "id")
    out = first_n(df, ["g"], ["t", "id"], 10_000)
    p = out._jdf.queryExecution().executedPlan().toString()
    kept, ranked = p.split("Union", 1)[1].split("Window", 1)
    assert "Exchange hashpartitioning" not in kept and ranked.count("Exchange hashpartitioning") == 2
    assert p.count("SortMergeJoin") == 0
    assert out.where("g = 'hot'").count() == 10_000 and out.where("g <> 'hot'").count() == 40_000
