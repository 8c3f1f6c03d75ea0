"""Independent DuckDB SQL for every registered query.

Written directly from the semantics (``NOT EXISTS`` for the removals, plain windows for the caps,
conditional sums for the pivot, ``CASE`` ladders for the formatters), not generated from the Spark
plans. The fixture views over ``events`` are re-derived here in SQL.
"""

from __future__ import annotations

import datetime as _dt

from ..constants import (FIRST_LEVEL_COLUMNS, KEY_LEVEL_COLUMNS, KEY_LEVEL_LAG_DAYS,
                         KEY_LEVEL_LAG_DAYS_STH, REGION_ORDER)
from . import params as P

_REGION_CASE = ("CASE user_id % 8 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(REGION_ORDER))
                + " END")

FIXTURE_CTES = f"""
base AS (
  SELECT event_id AS record_id,
         CAST(ts AS DATE) AS eventDate,
         ts AS eventDateTime,
         {_REGION_CASE} AS MR,
         CASE WHEN event_id % 4 = 2 THEN 'Cp06' WHEN event_id % 4 = 3 THEN 'CH02' ELSE 'CH01' END AS cpName,
         CAST(1 + event_id % 2 AS INTEGER) AS shoulder,
         CAST(CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS iflag,
         '79' || lpad(CAST(user_id AS VARCHAR), greatest(9, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS MSISDN,
         '25099' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS IMSI,
         '7918' || lpad(CAST((user_id * 7919) % 1000000 AS VARCHAR), 7, '0') AS origToNumber,
         'MSC' || CAST(user_id % 4 AS VARCHAR) AS MSCID,
         CAST(event_id % 3 AS VARCHAR) AS recType,
         event_type AS service,
         CAST(floor(epoch(ts)) AS BIGINT) AS timeKey,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS dateTime,
         'SRC' || CAST(event_id % 3 AS VARCHAR) AS source,
         CAST(floor(value) AS INTEGER) AS duration,
         CAST(floor(value * 1000) AS BIGINT) AS volume,
         '+03:00' AS gmtOffset,
         'TP' || CAST(user_id % 6 AS VARCHAR) AS TariffPlanName,
         CASE WHEN value >= 1 THEN 'RATED' ELSE 'ZERO' END AS RatingResult,
         CAST(event_id % 2 AS VARCHAR) AS ratingRes,
         CAST(CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS isRoam,
         CAST(event_id % 2 AS INTEGER) AS dch,
         'cdr_' || CAST(user_id % 10 AS VARCHAR) || '.csv' AS inputFileName,
         substr(strftime(ts, '%Y-%m-%d %H:%M:%S'), 12, 8) AS origTime,
         props AS udf,
         CAST(user_id % 100 AS VARCHAR) AS cellid,
         CAST(user_id % 7 AS VARCHAR) AS lac,
         {_REGION_CASE} AS region,
         'RP' || CAST(user_id % 3 AS VARCHAR) AS ratingPlan,
         CAST(event_id AS VARCHAR) AS reference,
         event_type AS filterGroup,
         '1' AS LOADED
  FROM events),
cdr_start AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM base WHERE record_id % 17 = 0
  UNION ALL SELECT * REPLACE (-record_id - 1 AS record_id, duration + 50 AS duration)
            FROM base WHERE record_id % 13 = 0),
cdr_rnd AS (
  SELECT CAST(ts AS DATE) AS eventDate,
         upper({_REGION_CASE}) AS macroregion,
         '25099' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS IMSI,
         '7918' || lpad(CAST((user_id * 7919) % 1000000 AS VARCHAR), 7, '0') AS origToNumber,
         event_type AS service,
         CAST(event_id % 3 AS VARCHAR) AS recType,
         CAST(floor(value) AS INTEGER) + CAST(event_id % 4 AS INTEGER) AS duration,
         strftime(ts + to_seconds(event_id % 5 + CASE WHEN event_id % 7 = 0 THEN 3600 ELSE 0 END),
                  '%Y-%m-%d %H:%M:%S') AS dateTime,
         CAST(floor(epoch(ts)) AS BIGINT) + event_id % 5
           + CASE WHEN event_id % 7 = 0 THEN 3600 ELSE 0 END AS timeKey
  FROM events WHERE event_id % 3 <> 0),
stat AS (
  SELECT eventDate, MR AS macroRegion, cpName,
         CAST(count(*) AS BIGINT) AS firstStream,
         CAST(count(CASE WHEN iflag = 0 THEN 1 END) AS BIGINT) AS secondStream,
         CAST(sum(CASE WHEN shoulder = 1 THEN 1 ELSE -1 END) AS BIGINT) AS firstDlt,
         CAST(sum(duration) AS BIGINT) AS dsc,
         CAST(count(CASE WHEN recType = '9' THEN 1 END) AS BIGINT) AS "2pass"
  FROM cdr_start GROUP BY eventDate, MR, cpName)
"""

_TARGET = f"DATE '{P.TARGET_DAY.isoformat()}'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([FIXTURE_CTES.strip(), *ctes]) + "\n"


def _cols(alias: str, cols) -> str:
    return ", ".join(f"{alias}.{c}" for c in cols)


_PE = "coalesce(epoch(try_strptime({x}, '%Y-%m-%d %H:%M:%S')), 0)"

_FIRST_SRC = f"""first_src AS (
  SELECT *, substr(dateTime, 1, 10) AS date, substr(dateTime, 12, 8) AS time
  FROM cdr_start WHERE eventDate = {_TARGET} AND cpName = 'CH01' AND iflag = 0)"""

_CAP_ON = f"(SELECT count(*) >= {P.CAP_TRIGGER} FROM first_src WHERE shoulder = 1)"


_PE_MIXED = (
    "coalesce(epoch(try_strptime({x}, '%Y-%m-%d %H:%M:%S')), "
    "epoch(try_strptime(regexp_replace({x}, '(:[0-9][0-9]:[0-9][0-9])[.][0-9]+$', '\\1'), "
    "['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%dT%H:%M', '%d.%m.%Y %H:%M:%S'])), "
    "CASE WHEN regexp_matches({x}, '^[0-9]{{9,11}}$') THEN CAST({x} AS DOUBLE) END, 0)")


def _mixed(table: str, number: str) -> str:
    return f"""SELECT * REPLACE (CASE (({number}) % 7 + 7) % 7
      WHEN 1 THEN replace(dateTime, ' ', 'T') WHEN 2 THEN dateTime || '.5'
      WHEN 3 THEN strftime(CAST(dateTime AS TIMESTAMP), '%d.%m.%Y %H:%M:%S') WHEN 4 THEN substr(dateTime, 1, 16)
      WHEN 5 THEN CAST(timeKey AS VARCHAR) WHEN 6 THEN 'at ' || dateTime ELSE dateTime END AS dateTime)
    FROM {table}"""


def _first_level_mixed() -> str:
    out = ", ".join(f"s.{c}" for c in FIRST_LEVEL_COLUMNS)
    src = f"""src AS (
  SELECT *, substr(dateTime, 1, 10) AS date, substr(dateTime, 12, 8) AS time
  FROM ({_mixed("cdr_start", "record_id")}) WHERE eventDate = {_TARGET} AND cpName = 'CH01' AND iflag = 0)"""
    matched = f"""matched AS (
  SELECT DISTINCT s.IMSI, s.origToNumber, s.service, s.recType, s.dateTime
  FROM src s JOIN ({_mixed("cdr_rnd", "timeKey")}) r
    ON r.eventDate = {_TARGET} AND s.IMSI = r.IMSI AND s.origToNumber = r.origToNumber
   AND s.service = r.service AND s.recType = r.recType
  WHERE abs(s.duration - r.duration) < 3
    AND abs({_PE_MIXED.format(x='s.dateTime')} - {_PE_MIXED.format(x='r.dateTime')}) < 3)"""
    return _with(src, matched) + f"""
SELECT DISTINCT {out} FROM src s
WHERE NOT EXISTS (SELECT 1 FROM matched m
                  WHERE m.IMSI = s.IMSI AND m.origToNumber = s.origToNumber
                    AND m.service = s.service AND m.recType = s.recType AND m.dateTime = s.dateTime)"""


def _first_level(capped: bool) -> str:
    if capped:
        src = f"""src AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hour(eventDateTime)
                                 ORDER BY eventDateTime, record_id) AS rn
    FROM first_src) t
  WHERE rn <= CASE WHEN {_CAP_ON} THEN {P.CAP_PER_HOUR} ELSE 9999999999 END)"""
        file_expr = f"CASE WHEN {_CAP_ON} THEN '!' || s.inputFileName ELSE s.inputFileName END"
    else:
        src = "src AS (SELECT * FROM first_src)"
        file_expr = "s.inputFileName"
    matched = f"""matched AS (
  SELECT DISTINCT s.IMSI, s.origToNumber, s.service, s.recType, s.dateTime
  FROM src s JOIN cdr_rnd r
    ON r.eventDate = {_TARGET} AND s.IMSI = r.IMSI AND s.origToNumber = r.origToNumber
   AND s.service = r.service AND s.recType = r.recType
  WHERE abs(s.duration - r.duration) < 3
    AND abs({_PE.format(x='s.dateTime')} - {_PE.format(x='r.dateTime')}) < 3)"""
    out = ", ".join(file_expr + " AS inputFileName" if c == "inputFileName" else f"s.{c}"
                    for c in FIRST_LEVEL_COLUMNS)
    return _with(_FIRST_SRC, src, matched) + f"""
SELECT DISTINCT {out}
FROM src s
WHERE NOT EXISTS (SELECT 1 FROM matched m
                  WHERE m.IMSI = s.IMSI AND m.origToNumber = s.origToNumber
                    AND m.service = s.service AND m.recType = s.recType
                    AND m.dateTime = s.dateTime)"""


_MOVED = """(SELECT * FROM cdr_start UNION ALL
        SELECT * REPLACE (substr(IMSI, 1, length(IMSI) - 1) AS IMSI, right(IMSI, 1) || origToNumber AS origToNumber)
        FROM cdr_start)"""


def _key_level(concat_key: bool, lag_sth: int = KEY_LEVEL_LAG_DAYS_STH, table: str = "cdr_start") -> str:
    d = f"DATE '{(P.AS_OF - _dt.timedelta(days=KEY_LEVEL_LAG_DAYS)).isoformat()}'"
    d_sth = f"DATE '{(P.AS_OF - _dt.timedelta(days=lag_sth)).isoformat()}'"
    src = f"""src AS (
  SELECT * FROM {table}
  WHERE eventDate = CASE WHEN MR = 'Sth' THEN {d_sth} ELSE {d} END
    AND cpName = 'Cp06' AND iflag = 0)"""
    cnt = f"""cnt AS (
  SELECT * FROM cdr_rnd
  WHERE eventDate BETWEEN (CASE WHEN macroregion = 'STH' THEN {d_sth} ELSE {d} END) - 1
                      AND (CASE WHEN macroregion = 'STH' THEN {d_sth} ELSE {d} END) + 1)"""
    keys = """keys AS (
  SELECT DISTINCT s.IMSI, s.origToNumber, s.service, s.recType
  FROM src s JOIN cnt r
    ON s.IMSI = r.IMSI AND s.origToNumber = r.origToNumber
   AND s.service = r.service AND s.recType = r.recType
  WHERE abs(s.duration - r.duration) < 3
    AND least(abs(s.timeKey - r.timeKey), abs(s.timeKey - r.timeKey + 3600),
              abs(s.timeKey - r.timeKey - 3600)) < 3)"""
    if concat_key:
        cond = "concat(k.IMSI, k.origToNumber, k.service, k.recType) = concat(s.IMSI, s.origToNumber, s.service, s.recType)"
    else:
        cond = ("k.IMSI = s.IMSI AND k.origToNumber = s.origToNumber AND k.service = s.service"
                " AND k.recType = s.recType")
    return _with(src, cnt, keys) + f"""
SELECT DISTINCT {_cols('s', KEY_LEVEL_COLUMNS)}
FROM src s
WHERE NOT EXISTS (SELECT 1 FROM keys k WHERE {cond})"""


def _pairs() -> str:
    return _with(_FIRST_SRC) + f"""
SELECT DISTINCT s.IMSI, s.origToNumber, s.service, s.recType, s.duration, s.dateTime,
       r.dateTime AS dateTime2
FROM first_src s JOIN cdr_rnd r
  ON r.eventDate = {_TARGET} AND s.IMSI = r.IMSI AND s.origToNumber = r.origToNumber
 AND s.service = r.service AND s.recType = r.recType
WHERE abs(s.duration - r.duration) < 3
  AND abs({_PE.format(x='s.dateTime')} - {_PE.format(x='r.dateTime')}) < 3"""


def _candidates() -> str:
    return _with(_FIRST_SRC) + f"""
SELECT DISTINCT IMSI, origToNumber, service, recType, duration, dateTime
FROM cdr_rnd
WHERE eventDate = {_TARGET}
  AND IMSI IN (SELECT IMSI FROM first_src)"""


def _lag_lookup() -> str:
    values = ", ".join(f"('{k}', {v})" for k, v in sorted(P.CHECK_LAGS.items()))
    return _with(f"dic(cpName, days_before) AS (VALUES {values})") + f"""
SELECT d.cpName, CAST(d.days_before AS INTEGER) AS days_before,
       CAST(DATE '{P.AS_OF.isoformat()}' - CAST(d.days_before AS INTEGER) AS DATE) AS target_date,
       CAST((SELECT count(*) FROM cdr_start s
             WHERE s.cpName = d.cpName
               AND s.eventDate = DATE '{P.AS_OF.isoformat()}' - CAST(d.days_before AS INTEGER)) AS BIGINT)
         AS source_rows
FROM dic d"""


def _limit_by_hour() -> str:
    return _with(_FIRST_SRC) + f"""
SELECT record_id, eventDateTime, hour, hour_rank FROM (
  SELECT record_id, eventDateTime, CAST(hour(eventDateTime) AS INTEGER) AS hour,
         row_number() OVER (PARTITION BY hour(eventDateTime) ORDER BY eventDateTime, record_id) AS hour_rank
  FROM first_src) t
WHERE hour_rank <= {P.CAP_PER_HOUR}"""


def _limit_by_subscriber() -> str:
    return _with() + f"""
SELECT record_id, eventDateTime, IMSI, CAST(hour(eventDateTime) AS INTEGER) AS hour FROM cdr_start
QUALIFY row_number() OVER (PARTITION BY hour(eventDateTime), IMSI ORDER BY eventDateTime, record_id) <= {P.CAP_PER_SUBSCRIBER}"""


def _limit_total() -> str:
    return _with(_FIRST_SRC) + f"""
, per_hour AS (
  SELECT *, row_number() OVER (PARTITION BY hour(eventDateTime) ORDER BY eventDateTime, record_id) AS hr
  FROM first_src),
capped AS (
  SELECT * FROM per_hour WHERE hr <= CASE WHEN {_CAP_ON} THEN {P.CAP_PER_HOUR} ELSE 9999999999 END),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY hour(eventDateTime), eventDateTime, record_id) AS pos
  FROM capped)
SELECT record_id, eventDateTime, duration FROM ordered
WHERE pos <= CASE WHEN {_CAP_ON} THEN {P.CAP_TOTAL_TIGHT} ELSE 9999999999 END"""


def _stat_daily() -> str:
    return _with() + "SELECT * FROM stat"


def _stat_pivot() -> str:
    metrics = P.PIVOT_METRICS
    long = "\n  UNION ALL ".join(
        f"SELECT macroRegion, cpName, '{m}' AS cpType, strftime(eventDate, '%Y-%m-%d') AS d, "
        f"CAST(\"{m}\" AS BIGINT) AS v FROM stat "
        f"WHERE eventDate IS NOT NULL AND macroRegion IS NOT NULL AND cpName IS NOT NULL"
        for m in metrics)
    days = sorted((d.isoformat() for d in P.PIVOT_DAYS), reverse=True)
    sums = ",\n       ".join(
        f"CAST(coalesce(sum(CASE WHEN d = '{d}' THEN v END), 0) AS BIGINT) AS \"{d}\"" for d in days)
    return _with(f"long AS (\n  {long})") + f"""
SELECT macroRegion, cpName, cpType,
       {sums}
FROM long
GROUP BY macroRegion, cpName, cpType
HAVING coalesce(sum(v), 0) <> 0"""


def _stat_extract() -> str:
    rank = ("CASE " + " ".join(f"WHEN macroRegion = '{r}' THEN '{i}'" for i, r in enumerate(REGION_ORDER))
            + " ELSE '' END")
    return _with() + f"""
SELECT eventDate, macroRegion, cpName AS chName, firstStream, secondStream, firstDlt, dsc, "2pass",
       row_number() OVER (ORDER BY cpName ASC NULLS LAST, {rank} ASC NULLS LAST,
                                   eventDate DESC NULLS LAST, macroRegion ASC NULLS LAST) AS pos
FROM stat"""


def _expected() -> str:
    regions = ", ".join(f"('{r}')" for r in P.CONTROL_REGIONS)
    checks = ", ".join(f"('{c}')" for c in P.CONTROL_CHECKS)
    return (f"regions(region) AS (VALUES {regions}),\nchecks(\"check\") AS (VALUES {checks}),\n"
            "expected AS (SELECT region, \"check\" FROM regions, checks)")


_CTL_DAY = f"DATE '{P.CONTROL_AS_OF.isoformat()}'"


def _control_gap() -> str:
    return _with(_expected()) + f"""
SELECT e.region, e."check" FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM cdr_start s
                  WHERE s.MR = e.region AND s.cpName = e."check"
                    AND s.eventDate = {_CTL_DAY} AND s.iflag = 1)"""


_STALE = f"""stale AS (
  SELECT e.region, e."check", n.last_date,
         CASE WHEN n.last_date IS NULL THEN 'missing' ELSE 'stale' END AS status
  FROM expected e
  LEFT JOIN (SELECT MR, cpName, max(eventDate) AS last_date FROM cdr_start
             WHERE eventDate <= {_CTL_DAY} AND iflag = 1 GROUP BY MR, cpName) n
    ON n.MR = e.region AND n.cpName = e."check"
  WHERE n.last_date IS NULL OR n.last_date <> {_CTL_DAY})"""

_LOW = f"""low AS (
  SELECT e.region, e."check", c.rows
  FROM expected e
  JOIN (SELECT MR, cpName, CAST(count(*) AS BIGINT) AS rows FROM cdr_start
        WHERE eventDate = {_CTL_DAY} AND iflag = 1 GROUP BY MR, cpName) c
    ON c.MR = e.region AND c.cpName = e."check"
  WHERE e."check" NOT IN ({", ".join(f"'{c}'" for c in P.CONTROL_NOT_EMPTY_CHECKED)})
    AND c.rows <= {P.CONTROL_MAX_ROWS})"""


def _control_stale() -> str:
    return _with(_expected(), _STALE) + "SELECT region, \"check\", last_date, status FROM stale"


def _control_low() -> str:
    return _with(_expected(), _LOW) + "SELECT region, \"check\", rows FROM low"


def _control_status() -> str:
    def part(src: str, kind: str) -> str:
        return f"""
SELECT c."check", '{kind}' AS kind,
       CASE WHEN count(x.region) > 0 THEN 'NOK' ELSE 'OK' END AS status,
       coalesce(string_agg(x.region, chr(10) ORDER BY x.region), '') AS items,
       strftime(TIMESTAMP '{P.CONTROL_CHECKED_AT.isoformat(sep=" ")}', '%d.%m.%Y %H:%M') AS checked_at
FROM checks c LEFT JOIN {src} x ON x."check" = c."check"
GROUP BY c."check\""""
    return _with(_expected(), _STALE, _LOW) + part("stale", "stale") + "\nUNION ALL" + part("low", "empty")


def _size(x: str) -> str:
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]
    whens = " ".join(
        f"WHEN abs({x}) < {1024 ** (i + 1)}.0 THEN printf('%.2f {u}', round({x} / {1024 ** i}.0, 2))"
        for i, u in enumerate(units[:-1]))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE printf('%.2f EiB', round({x} / {1024 ** 6}.0, 2)) END"


def _joblog_cte() -> str:
    return """jl AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 'QueryFinish' ELSE event_type END AS type,
         CAST(ts AS DATE) AS event_date, ts AS event_time,
         CAST(floor(value * 1000) AS BIGINT) AS query_duration_ms,
         user_id AS read_rows,
         CAST(floor(value * 1000000) AS BIGINT) AS read_bytes,
         CAST(floor(value * 1000000) AS BIGINT) AS memory_usage,
         event_id % 100 AS result_rows,
         CAST(floor(value * 1000000) AS BIGINT) AS result_bytes,
         'default' AS current_database,
         CASE WHEN event_id % 5 = 0 THEN 'select from system.' ELSE 'select from t' END || ' ' || props AS query,
         'Select' AS query_kind,
         'db.' || event_type AS tables,
         CASE WHEN user_id % 2 = 0 THEN 'airflow' ELSE 'other' END AS "user",
         'etl' AS os_user
  FROM events)"""


def _joblog_finished() -> str:
    s = "(CAST(floor(query_duration_ms / 1000) AS BIGINT) % 86400)"
    return "WITH " + _joblog_cte() + f"""
SELECT type, event_date, event_time,
       round_even(query_duration_ms / 1000 / 60 * 100, 0) / 100 AS query_duration_min,
       printf('%02d:%02d:%02d', CAST({s} // 3600 AS BIGINT), CAST(({s} % 3600) // 60 AS BIGINT),
              CAST({s} % 60 AS BIGINT)) AS query_duration,
       read_rows,
       {_size('CAST(read_bytes AS DOUBLE)')} AS read_Mb,
       {_size('CAST(memory_usage AS DOUBLE)')} AS RAM_usage_Mb,
       result_rows,
       {_size('CAST(result_bytes AS DOUBLE)')} AS result,
       current_database, query, query_kind, tables, "user", os_user
FROM jl
WHERE query NOT LIKE '%system%' AND "user" = '{P.JOBLOG_USER}' AND type = 'QueryFinish'
ORDER BY event_time DESC"""


def _joblog_running() -> str:
    units = [("year", 31536000), ("month", 2635200), ("day", 86400), ("hour", 3600), ("minute", 60),
             ("second", 1)]
    comps, rest = [], "t"
    for name, size in units:
        comps.append(f"({rest}) // {size} AS n_{name}")
        rest = f"({rest}) % {size}"
    parts = ", ".join(
        f"CASE WHEN n_{n} > 0 THEN CAST(n_{n} AS VARCHAR) || ' ' || "
        f"CASE WHEN n_{n} = 1 THEN '{n}' ELSE '{n}s' END END" for n, _ in units)
    return f"""WITH rj AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'airflow' ELSE 'other' END AS "user",
         CAST(event_id AS VARCHAR) AS query_id,
         CAST(floor(value * 1000) AS DOUBLE) AS elapsed,
         user_id AS read_rows,
         CAST(floor(value * 1000000) AS BIGINT) AS read_bytes,
         CAST(floor(value * 1000000) AS BIGINT) AS memory_usage,
         CAST(floor(value * 1000000) AS BIGINT) * 2 AS peak_memory_usage,
         CASE WHEN event_id % 5 = 0 THEN 'select from system.processes' ELSE 'select from t' END
           || ' ' || props AS query
  FROM events),
c AS (SELECT *, {", ".join(comps)} FROM (SELECT *, CAST(floor(abs(elapsed)) AS BIGINT) AS t FROM rj)),
p AS (SELECT *, list_filter([{parts}], lambda x: x IS NOT NULL) AS parts FROM c),
w AS (SELECT *, CASE WHEN len(parts) = 0 THEN '0 seconds'
                     WHEN len(parts) = 1 THEN parts[1]
                     ELSE array_to_string(parts[1:len(parts) - 1], ', ') || ' and ' || parts[len(parts)]
                END AS words FROM p)
SELECT "user", query_id,
       CASE WHEN elapsed IS NULL THEN NULL WHEN elapsed <= -1 THEN '-' || words ELSE words END AS elapsed_time,
       read_rows,
       {_size('CAST(read_bytes AS DOUBLE)')} AS read_memory,
       {_size('CAST(memory_usage AS DOUBLE)')} AS memory_use,
       {_size('CAST(peak_memory_usage AS DOUBLE)')} AS peak_memory,
       query
FROM w
WHERE query NOT LIKE '%system.processes%'
ORDER BY elapsed DESC"""


def _scalar_cut() -> str:
    return _with() + f"""
SELECT record_id, dateTime,
       substr(dateTime, 1, 10) AS date,
       substr(dateTime, 12, 8) AS time,
       CAST(substr(dateTime, 1, 10) AS DATE) AS day,
       CAST(hour(eventDateTime) AS INTEGER) AS hour,
       CAST(eventDate - {P.DAYS_BACK} AS DATE) AS day_minus_lag,
       CAST({_PE.format(x='dateTime')} AS BIGINT) AS epoch,
       '!' || inputFileName AS marked_file
FROM cdr_start"""


def _stat_pivot_full() -> str:
    from ..constants import STAT_METRICS
    days = sorted((d.isoformat() for d in P.PIVOT_DAYS), reverse=True)
    metrics = ", ".join(f"({i}, '{m}')" for i, m in enumerate(STAT_METRICS))
    sums = ",\n       ".join(
        f"CAST(count(*) FILTER (WHERE eventDate = DATE '{d}') AS BIGINT) AS \"{d}\"" for d in days)
    return _with(f"metrics(i, m) AS (VALUES {metrics})") + f"""
SELECT MR AS macroRegion, cpName, m AS cpType,
       {sums}, printf('%02d', i + 1) AS ordinal
FROM cdr_start JOIN metrics ON i = ((record_id % 31) + 31) % 31
WHERE eventDate IN ({", ".join(f"DATE '{d}'" for d in days)})
GROUP BY MR, cpName, m, i"""


def _joblog_finished_ordered() -> str:
    body = _joblog_finished().rsplit("ORDER BY", 1)[0]
    return (f"SELECT *, row_number() OVER (ORDER BY event_time DESC, query, read_rows, result_rows) AS pos "
            f"FROM ({body}) f")


def _joblog_running_ordered() -> str:
    return """SELECT CAST(event_id AS VARCHAR) AS query_id,
       row_number() OVER (ORDER BY CAST(floor(value * 1000) AS DOUBLE) DESC, CAST(event_id AS VARCHAR)) AS pos
FROM events WHERE event_id % 5 <> 0"""


def _path_parts() -> str:
    back = "replace(url, '/', chr(92))"
    return f"""SELECT page_id,
       contains(lower(url), 'blog') OR contains(lower(url), 'example.com') AS matches_any,
       ends_with(url, '.html') AND NOT contains(url, 'SMS') AND NOT contains(url, 'DateTime')
         AND NOT contains(url, 'DateCharge-Other') AND NOT contains(url, 'www') AS eligible,
       list_last(string_split(url, '/')) AS last_component,
       list_last(string_split(url, '/')) AS last_component_back,
       array_to_string(list_slice(string_split(url, '/'), 1, -2), '/') AS parent_dir,
       coalesce(list_filter(string_split(url, '/'), lambda x: lower(x) IN ('de', 'fr', 'en'))[1], '') AS segment,
       replace({back}, chr(92), '') AS stripped
FROM pages"""


def _latest_per_file() -> str:
    return _with() + """
SELECT dir, path, mtime FROM (
  SELECT '/landing/' || MR || '/' || cpName AS dir,
         '/landing/' || MR || '/' || cpName || '/f' || CAST(record_id AS VARCHAR) || '.csv' AS path,
         eventDateTime AS mtime,
         row_number() OVER (PARTITION BY MR, cpName ORDER BY eventDateTime DESC,
           '/landing/' || MR || '/' || cpName || '/f' || CAST(record_id AS VARCHAR) || '.csv' DESC) AS nth
  FROM cdr_start WHERE recType <> '1') t
WHERE nth = 1"""


def _empty_rerun() -> str:
    return f"SELECT * REPLACE (CAST(eventDate - 1 AS DATE) AS eventDate) FROM ({_first_level(False)}) f"


def _gzip_roundtrip() -> str:
    return _with() + f"""SELECT strftime(eventDate, '%Y-%m-%d') AS eventDate, macroRegion, cpName,
       CAST(firstStream AS VARCHAR) AS firstStream, CAST(secondStream AS VARCHAR) AS secondStream,
       CAST(firstDlt AS VARCHAR) AS firstDlt, CAST(dsc AS VARCHAR) AS dsc, CAST("2pass" AS VARCHAR) AS "2pass",
       DATE '{P.AS_OF.isoformat()}' AS export_date
FROM stat"""


def _csv_roundtrip() -> str:
    days = sorted((d.isoformat() for d in P.PIVOT_DAYS), reverse=True)
    cols = ", ".join(f'CAST("{d}" AS VARCHAR) AS "{d}"' for d in days)
    return f"SELECT macroRegion, cpName, cpType, {cols} FROM ({_stat_pivot()}) p"


def _zip_roundtrip() -> str:
    return f"SELECT * EXCLUDE (export_date) FROM ({_gzip_roundtrip()}) g"


def _versioned_rerun() -> str:
    return f"""WITH f AS ({_first_level(False)})
SELECT * FROM f WHERE record_id % 2 = 0 UNION ALL SELECT * REPLACE (CAST(eventDate - 1 AS DATE) AS eventDate) FROM f"""


def _lenient_forms() -> str:
    return """SELECT event_id, CASE WHEN event_id % 12 >= 10 THEN 0
       WHEN event_id % 12 = 2 THEN epoch_us(ts) // 60000000 * 60 ELSE epoch_us(ts) // 1000000 END::BIGINT AS epoch FROM events"""


def _landed(body: str) -> str:
    """The landed files as rows, by their definition over ``pages``."""
    day = (P.AS_OF - _dt.date(1970, 1, 1)).days
    return f"""
WITH file AS (
  SELECT page_id, ['MSK', 'CNT', 'NWE', 'VLG'][page_id % 4 + 1] AS region, 'CH0' || (page_id // 4 % 5 + 1) AS channel,
         'b' || (page_id // 200) AS batch, (page_id + page_id // 20) % 4 AS form,
         page_id || CASE WHEN page_id % 7 = 0 THEN '_SMS.csv' WHEN page_id % 11 = 0 THEN '.txt' ELSE ' a.csv' END AS name,
         ({day} - ((page_id % 20 + page_id // 200) % 5 + page_id // 20 % 3)) * 86400 + 43200 + page_id % 3600 AS seconds,
         strlen(page_id || ';' || coalesce(url, '')) + 1 AS row_bytes, page_id % 50 + 1 AS n
  FROM pages WHERE page_id IS NOT NULL
),
landed AS (
  SELECT *, region || '/' || batch || '/' || channel AS dir, seconds // 86400 = {day} AS today,
         CASE form WHEN 0 THEN 0 WHEN 1 THEN 6 WHEN 2 THEN 10 ELSE 6 + n * row_bytes END AS length,
         CASE form WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 1 + n END AS lines
  FROM file
),
newest AS (
  SELECT * FROM landed WHERE name LIKE '%.csv' AND name NOT LIKE '%SMS%'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY seconds DESC, name DESC) = 1
)
{body}"""


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _landed_facts() -> str:
    return _landed("SELECT dir || '/' || name AS path, name, length::BIGINT AS length, seconds::BIGINT AS seconds, "
                   "lines::BIGINT AS lines FROM landed")


def _landed_stale() -> str:
    return _landed("""SELECT 'daily' AS pass, d.dir, CASE WHEN n.dir IS NULL THEN 'missing' ELSE 'stale' END AS status
FROM (SELECT DISTINCT dir FROM landed) d LEFT JOIN newest n ON n.dir = d.dir WHERE n.dir IS NULL OR NOT n.today""")


def _landed_empty() -> str:
    return _landed(f"""SELECT 'daily' AS pass, dir, lines::BIGINT AS lines FROM newest
WHERE today AND lines <= 1 AND channel NOT IN ({_quoted(P.LANDED_NOT_EMPTY_CHECKED)})""")


def _landed_gap() -> str:
    return _landed(f"""SELECT region, channel FROM (SELECT unnest([{_quoted(P.LANDED_REGIONS)}]) AS region),
     (SELECT unnest([{_quoted(P.LANDED_CHANNELS)}]) AS channel)
EXCEPT SELECT region, channel FROM landed WHERE today AND name LIKE '%.csv'""")


ORACLE_SQL: dict[str, str] = {
    "recon_key_unmatched": _key_level(False),
    "recon_key_unmatched_concat": _key_level(True),
    "recon_second_unmatched": _first_level(False),
    "recon_second_capped": _first_level(True),
    "recon_matched_pairs": _pairs(),
    "recon_candidates_semi": _candidates(),
    "recon_candidates_bitmap": _candidates(),
    "recon_lag_lookup": _lag_lookup(),
    "limit_by_hour": _limit_by_hour(),
    "limit_total_capped": _limit_total(),
    "limit_by_subscriber": _limit_by_subscriber(),
    "stat_daily": _stat_daily(),
    "stat_pivot": _stat_pivot(),
    "stat_extract_ordered": _stat_extract(),
    "control_expected_minus_found": _control_gap(),
    "control_stale": _control_stale(),
    "control_low_volume": _control_low(),
    "control_status": _control_status(),
    "joblog_finished": _joblog_finished(),
    "joblog_running": _joblog_running(),
    "scalar_datetime_cut": _scalar_cut(),
    "sink_partitioned_roundtrip": _first_level(False),
    "sink_csv_roundtrip": _csv_roundtrip(),
    "recon_key_lag_sth": _key_level(False, lag_sth=P.LAG_STH),
    "recon_key_glued_plain": _key_level(False, table=_MOVED),
    "recon_key_glued_concat": _key_level(True, table=_MOVED),
    "recon_second_mixed_formats": _first_level_mixed(),
    "stat_pivot_full": _stat_pivot_full(),
    "joblog_finished_ordered": _joblog_finished_ordered(),
    "joblog_running_ordered": _joblog_running_ordered(),
    "path_parts": _path_parts(),
    "latest_per_file": _latest_per_file(),
    "sink_partitioned_empty_rerun": _empty_rerun(),
    "sink_gzip_roundtrip": _gzip_roundtrip(),
    "sink_versioned_rerun": _versioned_rerun(),
    "sink_zip_roundtrip": _zip_roundtrip(),
    "recon_key_bucketed": _key_level(False),
    "recon_second_bucketed": _first_level(False),
    "scalar_lenient_forms": _lenient_forms(),
    "landed_facts": _landed_facts(),
    "landed_stale": _landed_stale(),
    "landed_empty": _landed_empty(),
    "landed_expected_minus_found": _landed_gap(),
}
