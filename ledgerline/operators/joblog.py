"""Job-log reports (L1, L2) over any table shaped like a query log / running-job snapshot.

The original reads a database server's own log tables; here the reports run on tables, so a
cluster's job history (or any export of one) can be summarised the same way. Each report is a
filter, a projection of native formatting expressions and a distributed sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .position import with_position
from ..functions.readable import clock_text, minutes_2dp, readable_delta, readable_size


def with_report_position(report: DataFrame, newest: str, ties: Sequence[str]) -> DataFrame:
    """The report with ``pos``, its 1-based place by ``newest`` descending and ``ties`` (W6), from a
    distributed sort."""
    return with_position(report, [F.col(newest).desc(), *[F.col(t).asc() for t in ties]], "pos")


def finished_jobs(log: DataFrame, *, user: str | None = "airflow", kind: str = "QueryFinish",
                  exclude_like: Sequence[str] = ("%system%",)) -> DataFrame:
    """Finished jobs of one user, newest first, with duration in minutes (2 decimals) and as a
    clock, and sizes in readable units. The original selects the constant text ``'user'``; the
    filter on the ``user`` column shows the column was meant, so the column is returned."""
    cond = F.col("type") == F.lit(kind)
    if user is not None:
        cond = cond & (F.col("user") == F.lit(user))
    for pat in exclude_like:
        cond = cond & ~F.col("query").like(pat)
    return (log.where(cond)
            .select("type", "event_date", "event_time",
                    minutes_2dp("query_duration_ms").alias("query_duration_min"),
                    clock_text("query_duration_ms").alias("query_duration"),
                    "read_rows",
                    readable_size("read_bytes").alias("read_Mb"),
                    readable_size("memory_usage").alias("RAM_usage_Mb"),
                    "result_rows",
                    readable_size("result_bytes").alias("result"),
                    "current_database", "query", "query_kind", "tables", "user", "os_user")
            # newest first; the tiebreaks only let the range partitioner split a run of equal
            # times across tasks (the order among equal times is not defined by the report)
            .orderBy(F.col("event_time").desc(), "query", "read_rows", "result_rows"))


def running_jobs(snapshot: DataFrame, *, user: str | None = None,
                 exclude_like: Sequence[str] = ("%system.processes%",)) -> DataFrame:
    """Running jobs, longest first, elapsed time in words and sizes in readable units."""
    cond = F.lit(True)
    if user is not None:
        cond = cond & (F.col("user") == F.lit(user))
    for pat in exclude_like:
        cond = cond & ~F.col("query").like(pat)
    return (snapshot.where(cond)
            .orderBy(F.col("elapsed").desc(), "query_id")
            .select("user", "query_id",
                    readable_delta("elapsed").alias("elapsed_time"),
                    "read_rows",
                    readable_size("read_bytes").alias("read_memory"),
                    readable_size("memory_usage").alias("memory_use"),
                    readable_size("peak_memory_usage").alias("peak_memory"),
                    "query"))
