import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.datetime import lenient_epoch_sql
from ledgerline.operators import checks, match_tables
from ledgerline.operators.match_tables import MatchTables
from ledgerline.operators.recon import HOUR_SHIFT, SAME_SECOND
from ledgerline.sources import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 1, 18)


@pytest.fixture()
def big(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def tables(spark, folder, tol, time, left_carry, right_carry=()):
    ev = fx.load_events(spark, SF_DIR)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    t = MatchTables(f"m_{uuid.uuid4().hex}", str(folder), tol, time, time, left_carry, right_carry, buckets=4)
    t.write_left(start)
    t.write_right(rnd)
    return start, rnd, t


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def match_plan(df):
    """The match's part of the plan: the semi join and what is indented below it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [re.search(r"[A-Za-z*]", ln).start() for ln in lines]
    at = next(i for i, ln in enumerate(lines) if "LeftSemi" in ln)
    end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    return lines[at:end]


def test_key_level_is_the_same_and_reads_both_sides_without_exchange(big, tmp_path):
    start, rnd, t = tables(big, tmp_path, HOUR_SHIFT, "timeKey", ("MR", "cpName", "iflag"), ("macroregion",))
    got = match_tables.key_level_unmatched(start, t, AS_OF)
    assert rows(got) == rows(checks.key_level_unmatched(start, rnd, AS_OF))
    plan = match_plan(got)
    assert not [ln for ln in plan if "Exchange" in ln]
    scans = [ln for ln in plan if "FileScan" in ln]
    assert len(scans) == 2 and all("Bucketed: true" in ln and "PartitionFilters: [" in ln for ln in scans)
    lagged = match_tables.key_level_unmatched(start, t, AS_OF, lag_sth=5)
    assert rows(lagged) == rows(checks.key_level_unmatched(start, rnd, AS_OF, lag_sth=5))


def test_first_level_is_the_same_and_days_are_replaced(big, tmp_path):
    start, rnd, t = tables(big, tmp_path, SAME_SECOND, lenient_epoch_sql("dateTime"), ("dateTime", "cpName", "iflag"))
    want = rows(checks.first_level_unmatched(start, rnd, AS_OF, days_back=3))
    got = match_tables.first_level_unmatched(start, t, AS_OF, days_back=3)
    assert rows(got) == want and not [ln for ln in match_plan(got) if "Exchange" in ln]
    day, counted = dt.date(2024, 1, 15), t.right(big).count()
    # a rerun of a day replaces it, and the others stay
    t.write_right(rnd.where(f"eventDate = DATE'{day}'"))
    assert t.right(big).count() == counted
    assert rows(match_tables.first_level_unmatched(start, t, AS_OF, days_back=3)) == want
    t.write_right(rnd.where(f"eventDate = DATE'{day}'").limit(1))
    assert t.right(big).where(f"eventDate = DATE'{day}'").count() == 1
    t.clear_day(big, "right", day)
    assert t.right(big).where(f"eventDate = DATE'{day}'").count() == 0
    none = rnd.where("false")
    assert rows(match_tables.first_level_unmatched(start, t, AS_OF, days_back=3)) == \
        rows(checks.first_level_unmatched(start, none, AS_OF, days_back=3))
    assert t.right(big).where(f"eventDate <> DATE'{day}'").count() == rnd.where(f"eventDate <> DATE'{day}'").count()


@pytest.fixture()
def split(big):
    """Small advisory partitions, so few rows stand for many."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    old = {k: big.conf.get(k) for k in conf}
    for k, v in conf.items():
        big.conf.set(k, v)
    yield big
    for k, v in old.items():
        big.conf.set(k, v)


def own_events(spark, n):
    """Events of seven days around the run day, dealt over eight tasks."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-12 00:00:00' + make_dt_interval(0, 0, 0, CAST(id * 7919 % 604800 AS INT)) AS ts",
        "id % 97 AS user_id", "CASE WHEN id % 5 = 0 THEN 'purchase' ELSE 'view' END AS event_type",
        "CAST(id % 300 AS DOUBLE) AS value", "'p' AS props")


def most_rows_of_a_task(df):
    """Rows that the busiest of the writing tasks wrote, by the task number in the files' names."""
    task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    return max(r["count"] for r in df.groupBy(task.alias("task")).count().collect())


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_rows_of_a_writing_task_do_not_grow_with_the_table(split, tmp_path, adaptive):
    split.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        most, days = {}, 7
        for n in (2_000, 20_000):
            ev = own_events(split, n)
            start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
            t = MatchTables(f"m_{uuid.uuid4().hex}", str(tmp_path / str(n)), HOUR_SHIFT, "timeKey", "timeKey",
                            ("MR", "cpName", "iflag"), ("macroregion",), buckets=2)
            t.write_left(start)
            t.write_right(rnd)
            counted = t.left(split).count()
            most[n] = most_rows_of_a_task(t.left(split))
            t.write_left(start.where("eventDate = DATE'2024-01-15'"))        # every file of the day is replaced
            assert t.left(split).count() == counted
            got = match_tables.key_level_unmatched(start, t, AS_OF)
            assert rows(got) == rows(checks.key_level_unmatched(start, rnd, AS_OF)) != []
            assert not [ln for ln in match_plan(got) if "Exchange" in ln]
        if adaptive == "true":
            assert most[20_000] < 5 * most[2_000]                         # ten times the rows
        assert most[20_000] < counted / days
    finally:
        split.conf.set("spark.sql.adaptive.enabled", "true")
