"""Call-record, statistics and job-log views derived from the ``events`` table.

The original jobs read tables of call records, a statistics view and a job log that are not
part of the test data; these views derive rows of the same shape from ``events`` with plain
column expressions, so the work grows with ``events`` and an independent SQL form of the same
derivation can be run in DuckDB. Every derivation is a narrow projection (no shuffle) except the
statistics view, which is one partial-then-final aggregation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import REGION_ORDER, STAT_METRICS
from ..functions.datetime import DATETIME_FORMAT
from .tables import local_frame, read_table

TWIN_DURATION_OFFSET = 50


REGION_CASE = ("CASE user_id % 8 "
               + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(REGION_ORDER)) + " END")

def _padded(number: str, digits: int) -> str:
    """A number as text of at least ``digits`` digits; longer numbers keep all of theirs."""
    return f"lpad(CAST({number} AS STRING), greatest({digits}, length(CAST({number} AS STRING))), '0')"


_DT = f"date_format(ts, '{DATETIME_FORMAT}')"
# whole seconds since 1970-01-01 of the wall clock, independent of the session time zone
_EPOCH = ("CAST(datediff(to_date(ts), DATE'1970-01-01') AS BIGINT) * 86400 "
          "+ hour(ts) * 3600 + minute(ts) * 60 + second(ts)")


def _record_exprs(record_id: str, duration: str) -> list[str]:
    """SQL expressions of the 34 record columns (one JVM parse per column instead of a chain of
    column-API calls)."""
    return [
        f"{record_id} AS record_id",
        "to_date(ts) AS eventDate",
        "ts AS eventDateTime",
        f"{REGION_CASE} AS MR",
        "CASE WHEN event_id % 4 = 2 THEN 'Cp06' WHEN event_id % 4 = 3 THEN 'CH02' ELSE 'CH01' END AS cpName",
        "CAST(1 + event_id % 2 AS INT) AS shoulder",
        "CAST(CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS INT) AS iflag",
        f"concat('79', {_padded('user_id', 9)}) AS MSISDN",
        f"concat('25099', {_padded('user_id', 6)}) AS IMSI",
        "concat('7918', lpad(CAST((user_id * 7919) % 1000000 AS STRING), 7, '0')) AS origToNumber",
        "concat('MSC', CAST(user_id % 4 AS STRING)) AS MSCID",
        "CAST(event_id % 3 AS STRING) AS recType",
        "event_type AS service",
        f"CAST({_EPOCH} AS BIGINT) AS timeKey",
        f"{_DT} AS dateTime",
        "concat('SRC', CAST(event_id % 3 AS STRING)) AS source",
        f"{duration} AS duration",
        "CAST(floor(value * 1000) AS BIGINT) AS volume",
        "'+03:00' AS gmtOffset",
        "concat('TP', CAST(user_id % 6 AS STRING)) AS TariffPlanName",
        "CASE WHEN value >= 1 THEN 'RATED' ELSE 'ZERO' END AS RatingResult",
        "CAST(event_id % 2 AS STRING) AS ratingRes",
        "CAST(CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS INT) AS isRoam",
        "CAST(event_id % 2 AS INT) AS dch",
        "concat('cdr_', CAST(user_id % 10 AS STRING), '.csv') AS inputFileName",
        f"substring({_DT}, 12, 8) AS origTime",
        "props AS udf",
        "CAST(user_id % 100 AS STRING) AS cellid",
        "CAST(user_id % 7 AS STRING) AS lac",
        f"{REGION_CASE} AS region",
        "concat('RP', CAST(user_id % 3 AS STRING)) AS ratingPlan",
        "CAST(event_id AS STRING) AS reference",
        "event_type AS filterGroup",
        "'1' AS LOADED",
    ]


def cdr_base(events: DataFrame) -> DataFrame:
    """One call record per event (34 record columns plus ``eventDateTime`` and ``iflag``)."""
    return events.selectExpr(*_record_exprs("event_id", "CAST(floor(value) AS INT)"))


def cdr_start(events: DataFrame) -> DataFrame:
    """Source stream: every base record, exact copies of every 17th (DISTINCT must fold them)
    and a twin of every 13th with another id (negative, so it meets no event's) and a longer duration (same key
    and second).

    One scan: each event is exploded into its copies (kind 0 = record, 1 = exact copy,
    2 = twin) rather than unioning three scans, which would also make Catalyst push every later
    semi/anti join into each union branch."""
    copies = events.selectExpr(
        "*", "explode(array(0, CASE WHEN event_id % 17 = 0 THEN 1 END, "
             "CASE WHEN event_id % 13 = 0 THEN 2 END)) AS _kind").where("_kind IS NOT NULL")
    return copies.selectExpr(*_record_exprs(
        "CASE WHEN _kind = 2 THEN -event_id - 1 ELSE event_id END",
        f"CAST(floor(value) AS INT) + CASE WHEN _kind = 2 THEN {TWIN_DURATION_OFFSET} ELSE 0 END"))


def cdr_rnd(events: DataFrame) -> DataFrame:
    """Counterpart stream: two records in three, with duration moved by 0-3, time by 0-4 s and,
    for every 7th, one more hour; region code in upper case."""
    shift = "(event_id % 5 + CASE WHEN event_id % 7 = 0 THEN 3600 ELSE 0 END)"
    return events.where("event_id % 3 <> 0").selectExpr(
        "to_date(ts) AS eventDate",
        f"upper({REGION_CASE}) AS macroregion",
        f"concat('25099', {_padded('user_id', 6)}) AS IMSI",
        "concat('7918', lpad(CAST((user_id * 7919) % 1000000 AS STRING), 7, '0')) AS origToNumber",
        "event_type AS service",
        "CAST(event_id % 3 AS STRING) AS recType",
        "CAST(floor(value) AS INT) + CAST(event_id % 4 AS INT) AS duration",
        f"date_format(ts + make_dt_interval(0, 0, 0, CAST({shift} AS INT)), '{DATETIME_FORMAT}') AS dateTime",
        f"CAST({_EPOCH} + {shift} AS BIGINT) AS timeKey",
    )


def with_moved_keys(start: DataFrame) -> DataFrame:
    """The records and a second one of each whose IMSI has given its last digit to the head of the number: another
    key, but the same text when the parts are glued."""
    moved = start.selectExpr(*[
        "substring(IMSI, 1, length(IMSI) - 1) AS IMSI" if c == "IMSI"
        else "concat(right(IMSI, 1), origToNumber) AS origToNumber" if c == "origToNumber" else f"`{c}`"
        for c in start.columns])
    return start.unionByName(moved)


def mixed_times(df: DataFrame, number: str) -> DataFrame:
    """``dateTime`` rewritten in one of six forms by ``number``: as it is, with ``T``, with a fraction, day
    first, without seconds, as epoch seconds, and sometimes as no time at all."""
    t = "CAST(dateTime AS TIMESTAMP_NTZ)"
    return df.selectExpr("* EXCEPT (dateTime)", f"""CASE pmod({number}, 7)
        WHEN 1 THEN replace(dateTime, ' ', 'T') WHEN 2 THEN concat(dateTime, '.5')
        WHEN 3 THEN date_format({t}, 'dd.MM.yyyy HH:mm:ss') WHEN 4 THEN substring(dateTime, 1, 16)
        WHEN 5 THEN CAST(timeKey AS STRING) WHEN 6 THEN concat('at ', dateTime) ELSE dateTime END AS dateTime""")


def check_dictionary(spark: SparkSession, lags: dict[str, int]) -> DataFrame:
    """The check dictionary (check name -> days before the run day): configuration, a handful
    of rows."""
    return local_frame(spark, [(k, int(v)) for k, v in sorted(lags.items())],
                       "cpName string, days_before int")


def stat_daily(start: DataFrame) -> DataFrame:
    """Daily statistics per (eventDate, macroRegion, cpName), integer metrics only."""
    return (start.groupBy("eventDate", F.col("MR").alias("macroRegion"), "cpName")
            .agg(F.count(F.lit(1)).alias("firstStream"),
                 F.count(F.when(F.col("iflag") == 0, 1)).alias("secondStream"),
                 F.sum(F.when(F.col("shoulder") == 1, 1).otherwise(-1)).alias("firstDlt"),
                 F.sum("duration").cast("bigint").alias("dsc"),
                 F.count(F.when(F.col("recType") == "9", 1)).alias("2pass")))


def stat_full(start: DataFrame) -> DataFrame:
    """Daily statistics with all 30 metrics: metric number i counts the records whose id leaves i modulo 31."""
    return (start.groupBy("eventDate", F.col("MR").alias("macroRegion"), "cpName")
            .agg(*[F.count(F.when(F.expr(f"pmod(record_id, 31) = {i}"), 1)).alias(m)
                   for i, m in enumerate(STAT_METRICS)]))


def job_log(events: DataFrame) -> DataFrame:
    """A finished-jobs log: one job per event."""
    nbytes = "CAST(floor(value * 1000000) AS BIGINT)"
    return events.selectExpr(
        "CASE WHEN event_type = 'purchase' THEN 'QueryFinish' ELSE event_type END AS type",
        "to_date(ts) AS event_date",
        "ts AS event_time",
        "CAST(floor(value * 1000) AS BIGINT) AS query_duration_ms",
        "user_id AS read_rows",
        f"{nbytes} AS read_bytes",
        f"{nbytes} AS memory_usage",
        "event_id % 100 AS result_rows",
        f"{nbytes} AS result_bytes",
        "'default' AS current_database",
        "concat(CASE WHEN event_id % 5 = 0 THEN 'select from system.' ELSE 'select from t' END, "
        "' ', props) AS query",
        "'Select' AS query_kind",
        "concat('db.', event_type) AS tables",
        "CASE WHEN user_id % 2 = 0 THEN 'airflow' ELSE 'other' END AS user",
        "'etl' AS os_user",
    )


def running_jobs(events: DataFrame) -> DataFrame:
    """A snapshot of running jobs: one per event, elapsed seconds from the event value."""
    nbytes = "CAST(floor(value * 1000000) AS BIGINT)"
    return events.selectExpr(
        "CASE WHEN user_id % 2 = 0 THEN 'airflow' ELSE 'other' END AS user",
        "CAST(event_id AS STRING) AS query_id",
        "CAST(floor(value * 1000) AS DOUBLE) AS elapsed",
        "user_id AS read_rows",
        f"{nbytes} AS read_bytes",
        f"{nbytes} AS memory_usage",
        f"{nbytes} * 2 AS peak_memory_usage",
        "concat(CASE WHEN event_id % 5 = 0 THEN 'select from system.processes' "
        "ELSE 'select from t' END, ' ', props) AS query",
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


# ---------------------------------------------------------------------------------------------
# landed files


def landed_pages(spark: SparkSession, sf_dir: str, as_of) -> DataFrame:
    """A file per page: ``path`` (below a root; <region>/<batch>/<channel>/<name>), ``content`` of none, one, two or
    more lines, and ``seconds`` (UTC) of its modification, on ``as_of`` or up to six days before."""
    day = (as_of - _dt.date(1970, 1, 1)).days
    return read_table(spark, sf_dir, "pages").where("page_id IS NOT NULL").selectExpr(
        """concat_ws('/', element_at(array('MSK', 'CNT', 'NWE', 'VLG'), cast(page_id % 4 AS int) + 1),
                     concat('b', cast(floor(page_id / 200) AS string)), concat('CH0', cast(floor(page_id / 4) % 5 + 1 AS string)),
                     concat(cast(page_id AS string), CASE WHEN page_id % 7 = 0 THEN '_SMS.csv' WHEN page_id % 11 = 0 THEN '.txt'
                                                          ELSE ' a.csv' END)) AS path""",
        """CASE (page_id + floor(page_id / 20)) % 4 WHEN 0 THEN '' WHEN 1 THEN 'h1;h2\\n' WHEN 2 THEN 'h1;h2\\r\\n1;2'
             ELSE concat('h1;h2\\n', repeat(concat(cast(page_id AS string), ';', coalesce(url, ''), '\\n'),
                                           cast(page_id % 50 + 1 AS int))) END AS content""",
        f"""({day} - ((page_id % 20 + floor(page_id / 200)) % 5 + floor(page_id / 20) % 3)) * 86400 + 43200
             + page_id % 3600 AS seconds""")


def write_landed(files: DataFrame, root: str) -> int:
    """Write ``files(path, content, seconds)`` below ``root``, a folder that driver and executors share, in
    tasks; a repeated task writes the same again. Returns their number."""
    from .files import _norm, workers_can_import
    base = _norm(root)
    workers_can_import(files.sparkSession)

    def run(batches):
        import os

        import pyarrow as pa
        for batch in batches:
            for path, content, seconds in zip(*(batch.column(i).to_pylist() for i in range(3))):
                target = os.path.join(base, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(target, "wb") as f:
                    f.write(content.encode())
                os.utime(target, (seconds, seconds))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], type=pa.int64())], ["n"])

    return files.select("path", "content", "seconds").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0
