"""Record tables laid out for the match.

The match joins on the call keys and a time bucket. ``MatchTables`` writes both sides of a check once, as tables that are
bucketed by just these columns and partitioned by day, so the daily check, its reruns and the days either side
read them bucket by bucket: neither side is shuffled again for the match. Days are written by one shuffle on the day and the
bucket, so the tasks that sort and write grow in number with the rows, not with the buckets: a (day, bucket) is one file, and
adaptive execution splits one that is over its advisory partition size into several, which Spark reads as one bucket.

The left table holds a row per record, clock shift and time bucket that its window touches, the right one a row per record;
both carry the columns that the check filters or removes by, and nothing else. A record of a busy subscriber is in the
bucket of its few seconds, so no file holds a subscriber. One layout serves one ``Tolerance`` and one pair of time
expressions, which is why they belong to the object and not to the calls.

Defined results: those of ``recon.matched_left``; a NULL key or time matches nothing; writing a day again replaces that day and
leaves the others; a day without records leaves what was written before (write it through ``clear_day``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CALL_KEY
from ..functions.text import quote_ident as _q
from . import checks
from .recon import Tolerance, condition, left_rows, right_rows


@dataclass(frozen=True)
class MatchTables:
    """``name`` and ``path`` are the prefix of the two tables' names in the catalog and their folder. ``buckets`` is set for
    a day's rows: about 200 MB a bucket."""
    name: str
    path: str
    tol: Tolerance
    left_time: str
    right_time: str
    left_carry: Sequence[str] = ()
    right_carry: Sequence[str] = ()
    keys: Sequence[str] = tuple(CALL_KEY)
    duration: str = "duration"
    day_col: str = "eventDate"
    buckets: int = 64

    def write_left(self, df: DataFrame) -> None:
        rows = left_rows(df, self.keys, self.left_time, self.duration, self.tol, [*self.left_carry, self.day_col], self.tol.shifts)
        self._write(rows, "left")

    def write_right(self, df: DataFrame) -> None:
        rows = right_rows(df, self.keys, self.right_time, self.duration, self.tol, [*self.right_carry, self.day_col])
        self._write(rows, "right")

    def _write(self, rows: DataFrame, side: str) -> None:
        spark, table, at = rows.sparkSession, f"{self.name}_{side}", [*self.keys, "_bucket"]
        # the bucket as Spark's writer computes it; a column, since the hint takes no expressions
        rows = rows.withColumn("_file", F.expr(f"pmod(hash({', '.join(_q(c) for c in at)}), {int(self.buckets)})"))
        by = F.col(_q(self.day_col)), F.col("_file")
        adaptive = spark.conf.get("spark.sql.adaptive.enabled").lower() == "true"        # without it Spark ignores the hint
        rows = (rows.hint("rebalance", *by) if adaptive else rows.repartition(*by)).drop("_file")
        if spark.catalog.tableExists(table):
            rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
            return
        (rows.write.format("parquet").option("path", f"{self.path.rstrip('/')}/{side}")
             .option("partitionOverwriteMode", "dynamic").partitionBy(self.day_col)
             .bucketBy(int(self.buckets), *at).sortBy(*at).saveAsTable(table))

    def clear_day(self, spark: SparkSession, side: str, day: _dt.date) -> None:
        """Forget a day of one side."""
        spark.sql(f"ALTER TABLE {self.name}_{side} DROP IF EXISTS PARTITION ({_q(self.day_col)} = DATE'{day.isoformat()}')")

    def left(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_left")

    def right(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_right")

    def matched(self, left: DataFrame, right: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """The keys and ``carry`` columns of (filtered) left rows that match some (filtered) right row."""
        met = left.alias("l").join(right.alias("r"), condition(self.keys, self.tol), "left_semi")
        return met.select(*[F.col(f"l.{_q(c)}") for c in [*self.keys, *carry]])


def key_level_unmatched(start: DataFrame, tables: MatchTables, as_of, **which) -> DataFrame:
    """The key-level check (``checks.key_level_unmatched``) with both sides of its match read from ``tables``, whose left rows
    carry ``MR``, ``cpName`` and ``iflag`` and whose right rows carry ``macroregion``."""
    spark = start.sparkSession
    lags = {k: which[k] for k in ("lag", "lag_sth") if k in which}
    matched = tables.matched(checks.key_level_source(tables.left(spark), as_of, **which),
                             checks.key_level_counterpart(tables.right(spark), as_of, **lags))
    rows = checks.key_level_source(start, as_of, **which).selectExpr(*[_q(c) for c in checks.KEY_LEVEL_COLUMNS]).distinct()
    return rows.join(matched.distinct(), list(tables.keys), "left_anti").select(*[_q(c) for c in rows.columns])


def first_level_unmatched(start: DataFrame, tables: MatchTables, as_of, *, days_back: int,
                          check: str = checks.FIRST_LEVEL_CHECK) -> DataFrame:
    """The first-level check without caps, with both sides of its match read from ``tables``, whose left rows carry
    ``dateTime``, ``cpName`` and ``iflag``."""
    spark, day = start.sparkSession, checks.days_before(as_of, days_back)
    matched = tables.matched(checks.first_level_source(tables.left(spark), day, check),
                             tables.right(spark).where(f"{_q(tables.day_col)} = DATE'{day.isoformat()}'"), ["dateTime"])
    rows = checks.first_level_source(start, day, check).selectExpr(
        "*", "substring(dateTime, 1, 10) AS date", "substring(dateTime, 12, 8) AS time")
    left = rows.join(matched.distinct(), [*tables.keys, "dateTime"], "left_anti")
    return left.selectExpr(*[_q(c) for c in checks.FIRST_LEVEL_COLUMNS]).distinct()
