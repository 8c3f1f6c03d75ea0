"""Human-readable formatting as column expressions.

Each function is one native expression (``CASE`` ladders, ``format_string``, ``concat_ws``), so a
report over a billion-row job log stays inside whole-stage codegen. Every function has a SQL-text
form (``*_sql``, taking a SQL expression) and a column form taking a column name, which parses
the SQL text once on the JVM instead of building the expression node by node.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import quote_ident as _q

# Size units, each 1024 times the previous.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]

# Time-delta units and their length in seconds (a year is 365 days, a month
# 30.5 days), largest first, with singular and plural words.
DELTA_UNITS = [
    ("year", "years", 31_536_000),
    ("month", "months", 2_635_200),
    ("day", "days", 86_400),
    ("hour", "hours", 3_600),
    ("minute", "minutes", 60),
    ("second", "seconds", 1),
]


def minutes_2dp_sql(ms: str) -> str:
    """``round(ms / 1000 / 60, 2)`` with float rounding, ties to even (F10). ``rint`` works on the
    binary double, as the source dialect does; ``round``/``bround`` work on its decimal text and
    differ on ties such as 74,700 ms."""
    return f"rint(CAST({ms} AS DOUBLE) / 1000 / 60 * 100) / 100"


def clock_text_sql(ms: str) -> str:
    """Milliseconds as ``HH:mm:ss`` of a UTC clock, wrapping after 24 hours."""
    s = f"pmod(CAST(floor(CAST({ms} AS DOUBLE) / 1000) AS BIGINT), 86400)"
    return f"format_string('%02d:%02d:%02d', {s} div 3600, ({s} % 3600) div 60, {s} % 60)"


def readable_size_sql(n: str) -> str:
    """Bytes in 1024-based units with two decimals: ``0.00 B``, ``1.50 KiB``, ``953.67 MiB``.
    The value is cast to double first (``format_string('%.2f')`` rejects decimals). One unit index
    from a comparison ladder, one ``format_string``: small enough to stay in codegen next to other
    formatters."""
    x = f"CAST({n} AS DOUBLE)"
    last = len(SIZE_UNITS) - 1
    idx = ("CASE " + " ".join(f"WHEN abs({x}) < {float(1024 ** (i + 1))!r}D THEN {i + 1}"
                              for i in range(last)) + f" ELSE {last + 1} END")
    divisors = ", ".join(f"{float(1024 ** i)!r}D" for i in range(last + 1))
    units = ", ".join(f"'{u}'" for u in SIZE_UNITS)
    return (f"CASE WHEN {x} IS NULL THEN CAST(NULL AS STRING) ELSE "
            f"format_string('%.2f %s', {x} / element_at(array({divisors}), {idx}), "
            f"element_at(array({units}), {idx})) END")


def readable_delta_sql(seconds: str) -> str:
    """Seconds in words: ``1 hour, 2 minutes and 5 seconds``; zero is ``0 seconds``.
    Whole seconds (the fraction is dropped); zero units are left out; a value of -1 or less
    gets a leading ``-``. A year and a month are whole numbers of hours, so minutes and seconds
    come straight from the total."""
    (y1, yn, ys), (m1, mn, ms), (d1, dn, ds), (h1, hn, hs), (i1, i_n, i_s), (s1, sn, _) = DELTA_UNITS
    x = f"CAST({seconds} AS DOUBLE)"
    t = f"CAST(floor(abs({x})) AS BIGINT)"
    after_months = f"(({t} % {ys}) % {ms})"
    counts = [(f"({t} div {ys})", y1, yn), (f"(({t} % {ys}) div {ms})", m1, mn),
              (f"({after_months} div {ds})", d1, dn), (f"(({after_months} % {ds}) div {hs})", h1, hn),
              (f"(({t} % {hs}) div {i_s})", i1, i_n), (f"({t} % {i_s})", s1, sn)]
    parts = [f"CASE WHEN {k} > 0 THEN concat(CAST({k} AS STRING), "
             f"CASE WHEN {k} = 1 THEN ' {one}' ELSE ' {many}' END) END" for k, one, many in counts]
    joined = f"concat_ws(', ', {', '.join(parts)})"
    return (f"CASE WHEN {x} IS NULL THEN CAST(NULL AS STRING) "
            f"ELSE concat(CASE WHEN {x} <= -1 THEN '-' ELSE '' END, "
            f"CASE WHEN {t} = 0 THEN '0 seconds' "
            f"ELSE regexp_replace({joined}, ', ([^,]*)$', ' and $1') END) END")


def _col(sql_fn, name: str) -> Column:
    if not isinstance(name, str):
        raise TypeError("readable formatters take a column name; select the expression as a "
                        "named column first")
    return F.expr(sql_fn(_q(name)))


def minutes_2dp(ms: str) -> Column:
    return _col(minutes_2dp_sql, ms)


def clock_text(ms: str) -> Column:
    return _col(clock_text_sql, ms)


def readable_size(n: str) -> Column:
    return _col(readable_size_sql, n)


def readable_delta(seconds: str) -> Column:
    return _col(readable_delta_sql, seconds)

