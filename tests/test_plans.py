"""Plan-shape checks: the properties the scale design depends on, asserted on the physical plan
as it is planned for large inputs (automatic broadcast off)."""

import re

import pytest

from ledgerline.operators import checks
from ledgerline.operators.caps import limit_by
from ledgerline.plans.queries import stat_pivot
from ledgerline.sources import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def big(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark):
    ev = fx.load_events(spark, SF_DIR)
    return fx.cdr_start(ev), fx.cdr_rnd(ev)


def test_key_level_anti_join_is_last(big):
    s, r = tables(big)
    p = plan(checks.key_level_unmatched(s, r, "2024-01-18", broadcast=None))
    ops = [ln.strip(" :+-*()0123456789") for ln in p.splitlines()]
    body = [o for o in ops if o and not o.startswith(("AdaptiveSparkPlan", "Project", "ColumnarToRow"))]
    # nothing above the anti join needs its key partitioning, so AQE may split a hot key
    assert body[0].startswith("SortMergeJoin") and "LeftAnti" in body[0]
    assert "LeftSemi" in p                      # the match is an existence test, not a pair list


def test_capped_match_streams_counterpart(big):
    s, r = tables(big)
    p = plan(checks.first_level_unmatched(s, r, "2024-01-18", days_back=3,
                                          caps=checks.CapRule(1, 5, 1_000_000),
                                          broadcast=checks.BroadcastRule()))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p
    assert "LeftSemi" not in p
    # the counterpart scan (reads no props column) feeds the broadcast join without an exchange
    join = p[p.index("BroadcastHashJoin"):]
    first_child = join.split("BroadcastExchange")[0]
    assert "Exchange" not in first_child.replace("BroadcastHashJoin", "")


def test_uncapped_large_source_shuffles_on_keys_and_bucket(big):
    s, r = tables(big)
    p = plan(checks.first_level_unmatched(s, r, "2024-01-18", days_back=3, caps=None,
                                          broadcast=checks.BroadcastRule(max_bytes=0)))
    assert "LeftSemi" in p and "LeftAnti" in p and "BroadcastExchange" not in p
    assert re.search(r"hashpartitioning\([^)]*_bucket", p)


def test_caps_plan_window_group_limit(spark):
    s, _ = tables(spark)
    df = limit_by(s.selectExpr("*", "hour(eventDateTime) AS h"), ["h"], ["eventDateTime", "record_id"], 5)
    p = plan(df)
    assert p.count("WindowGroupLimit") >= 2      # trimmed inside map tasks before each shuffle


def test_production_cap_ranks_only_the_cut_seconds(big):
    """At the shipped cap no window sees the day: rows before the cut pass a literal filter, unshuffled."""
    from ledgerline.operators.caps import cut_by_hour
    s, _ = tables(big)
    src = checks.first_level_source(s, __import__("datetime").date(2024, 1, 15))
    whole = plan(cut_by_hour(src, 10_000))
    assert "Window" not in whole and "Exchange" not in whole      # nothing to cut in this day
    assert "Window" not in plan(cut_by_hour(src, 1))              # every limit falls between two seconds
    hot = big.range(40_000).selectExpr(
        "id AS record_id", "CASE WHEN id < 20000 THEN TIMESTAMP_NTZ'2024-01-15 07:30:01' "
        "ELSE TIMESTAMP_NTZ'2024-01-15 07:00:00' + make_dt_interval(0, 0, 0, id % 1500) END AS eventDateTime")
    kept, ranked = plan(cut_by_hour(hot, 25_000)).split("Union", 1)[1].split("Window", 1)
    assert "2024-01-15 07:30:01" in ranked                          # only the rows of the cut second are ranked
    assert ranked.count("Exchange hashpartitioning") == 2 and "Exchange" not in kept


def test_key_level_reads_the_day_twice_and_narrow(big):
    s, r = tables(big)
    p = plan(checks.key_level_unmatched(s, r, "2024-01-18"))
    scans = [ln for ln in p.splitlines() if "FileScan" in ln]
    assert len(scans) == 3                                          # rows, match, counterpart
    # one DISTINCT over the 19 output columns, not two
    assert len([ln for ln in p.splitlines() if "HashAggregate(keys=" in ln and "TariffPlanName" in ln]) == 2


def test_candidates_distinct_below_semi_join(big):
    s, r = tables(big)
    p = plan(checks.candidates_for_day(s, r, "2024-01-18", days_back=3))
    body = [ln for ln in p.splitlines() if "Join" in ln or "Aggregate" in ln]
    assert "LeftSemi" in body[0]


def test_low_volume_scans_one_day(spark):
    from ledgerline.plans.queries import control_low_volume
    p = plan(control_low_volume(spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-15T00:00\).*LessThan\(ts,2024-01-16T00:00\)", p)


def test_day_filter_reaches_scan(spark):
    s, r = tables(spark)
    p = plan(checks.first_level_source(s, __import__("datetime").date(2024, 1, 15)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-15T00:00\)", p)


def test_pivot_single_aggregation_shuffle(big):
    from ledgerline.operators import pivot
    from ledgerline.plans import params as P
    stat = fx.stat_daily(tables(big)[0])
    p = plan(pivot.stat_pivot(stat, P.PIVOT_METRICS, P.PIVOT_DAYS))
    # one shuffle for the statistics, one for the pivot, one range shuffle for the report order
    assert p.count("Exchange hashpartitioning") == 2
    assert p.count("Exchange rangepartitioning") == 1
    # without a list of dates the sums are written and read back: no second read of the records
    p = plan(stat_pivot(big, SF_DIR))
    assert p.count("Exchange hashpartitioning") == 1 and "FileScan" not in p


def test_broadcast_decision_uses_measured_width(spark):
    from pyspark.sql import functions as F
    s, _ = tables(spark)
    day = __import__("datetime").date(2024, 1, 15)
    src = checks.first_level_source(s, day)
    cap = checks.first_level_cap(src, None)
    assert cap.source_rows == 11 and 30 < cap.row_bytes < 80
    rule = checks.BroadcastRule(max_bytes=10_000)
    assert rule.allows(checks.capped_rows_bound(cap), copies=2, text_bytes=cap.row_bytes)
    wide = src.withColumn("service", F.when(F.col("record_id") == F.lit(src.first().record_id),
                                            F.lit("x" * 50_000)).otherwise(F.col("service")))
    wcap = checks.first_level_cap(wide, None)
    assert wcap.row_bytes > 50_000
    assert not rule.allows(checks.capped_rows_bound(wcap), copies=2, text_bytes=wcap.row_bytes)


def test_times_are_parsed_once_a_row_and_not_in_filters(spark):
    """The join's bucket is never NULL, so no filter copies the parse below the projections."""
    from ledgerline.plans.queries import recon_second_mixed_formats
    p = recon_second_mixed_formats(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    parsing = [ln.strip(" :+-") for ln in p.splitlines() if "translate(" in ln]
    assert len(parsing) == 2 and all(ln.startswith("Project") for ln in parsing)
