"""Every registered query against its DuckDB oracle (sf0.001 by default; set
LEDGERLINE_TEST_SF=0.01 for the driver's scale), plus the fixture counts of FIXTURES.md."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from compare import compare, duck
from ledgerline.operators import checks
from ledgerline.plans.queries import QUERIES
from ledgerline.sources import fixtures as fx

SF = os.environ.get("LEDGERLINE_TEST_SF", "0.001")
SF_DIR = f"/root/testdata/sf{SF}"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry_mod.queries()[name](spark, SF_DIR), con, entry_mod.oracle_sql()[name])
    assert ok, msg


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) and set(QUERIES) <= set(entry_mod.queries())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and "inputFileName" in df.columns


EXPECTED = {  # FIXTURES.md section 3
    "0.001": dict(start=(1136, 1937242100287), rnd=(666, 1135743832861), first=(7, 3548),
                  first_capped=(7, 3548), key_level=(6, 2039), candidates=14),
    "0.01": dict(start=(11359, 19371205898806), rnd=(6666, 11367946159820), first=(106, 424607),
                 first_capped=(75, 284749), key_level=(43, 188088), candidates=164),
}


@pytest.mark.skipif(SF not in EXPECTED, reason="no published counts")
def test_fixture_counts(spark):
    e = EXPECTED[SF]
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)

    def cs(df, col):
        r = df.agg(F.count(F.lit(1)), F.sum(col)).first()
        return (r[0], r[1])

    assert cs(start, "timeKey") == e["start"]
    assert cs(rnd, "timeKey") == e["rnd"]
    assert cs(checks.first_level_unmatched(start, rnd, "2024-01-18", days_back=3, caps=None),
              "record_id") == e["first"]
    # the shuffled plan (source above the broadcast bound) gives the same rows
    for rule in (None, checks.BroadcastRule(), checks.BroadcastRule(max_bytes=0)):
        assert cs(checks.first_level_unmatched(start, rnd, "2024-01-18", days_back=3, caps=None,
                                               broadcast=rule), "record_id") == e["first"]
        assert cs(checks.first_level_unmatched(start, rnd, "2024-01-18", days_back=3,
                                               caps=checks.CapRule(50, 5, 1_000_000), broadcast=rule),
                  "record_id") == e["first_capped"]
    assert cs(checks.first_level_unmatched(start, rnd, "2024-01-18", days_back=3,
                                           caps=checks.CapRule(50, 5, 1_000_000)), "record_id") == e["first_capped"]
    from ledgerline.operators.recon import HOUR_SHIFT, unmatched_by_key
    src = checks.key_level_source(start, "2024-01-18")
    cnt = checks.key_level_counterpart(rnd, "2024-01-18")
    assert cs(unmatched_by_key(src, cnt, tol=HOUR_SHIFT).select("record_id").distinct(),
              "record_id") == e["key_level"]
    assert checks.candidates_for_day(start, rnd, "2024-01-18", days_back=3).count() == e["candidates"]
    kl = {tuple(r) for r in checks.key_level_unmatched(start, rnd, "2024-01-18").collect()}
    for rule in (checks.BroadcastRule(), checks.BroadcastRule(max_bytes=0)):
        assert {tuple(r) for r in checks.key_level_unmatched(start, rnd, "2024-01-18",
                                                             broadcast=rule).collect()} == kl


@pytest.mark.parametrize("sf,after,cancelled", [("0.001", 93, 3), ("0.01", 96, 0)])
def test_pivot_counts_of_fixtures(spark, sf, after, cancelled):
    import datetime as dt
    from ledgerline.operators.pivot import stat_pivot
    from ledgerline.plans import params as P
    d = f"/root/testdata/sf{sf}"
    if not os.path.isdir(d):
        pytest.skip("test data not present")
    stat = fx.stat_daily(fx.cdr_start(fx.load_events(spark, d)))
    days = [dt.date(2024, 1, 13), dt.date(2024, 1, 14), dt.date(2024, 1, 15)]
    out = stat_pivot(stat, P.PIVOT_METRICS, days)
    assert out.count() == after
    # rows with some non-zero day whose days cancel: observed rows minus kept minus all-zero rows
    obs = stat.where(F.col("eventDate").isin(days)).select("macroRegion", "cpName").distinct().count()
    cells = stat.where(F.col("eventDate").isin(days))
    all_zero = 0
    for m in P.PIVOT_METRICS:
        nz = cells.groupBy("macroRegion", "cpName").agg(F.max(F.abs(F.col(f"`{m}`"))).alias("mx"))
        all_zero += nz.where(F.col("mx") == 0).count()
    assert obs * len(P.PIVOT_METRICS) == 120
    assert obs * len(P.PIVOT_METRICS) - after - all_zero == cancelled
