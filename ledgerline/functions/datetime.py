"""Date and time column expressions.

All are native Spark expressions, so they stay inside whole-stage codegen. None reads the
wall clock: the reference day is always an argument (``as_of``), so a rerun gives the same rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

#: text forms of a time that the checks read; the pseudo forms ``epoch`` and ``epoch_ms`` are whole seconds (9 to 11) and
#: milliseconds (13) as digits. ``XXX`` is a zone: ``Z``, ``+03:00`` or ``+0300``
LENIENT_FORMATS = (DATETIME_FORMAT, "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm",
                   "dd.MM.yyyy HH:mm:ss", "epoch", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXXX",
                   "dd MMM yyyy HH:mm:ss", "dd-MMM-yyyy HH:mm:ss", "epoch_ms")

_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

_EPOCH = _dt.date(1970, 1, 1)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d: str | _dt.date) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def days_before(as_of: str | _dt.date, n: int) -> _dt.date:
    """``today() - n`` with the reference day as an argument."""
    return as_date(as_of) - _dt.timedelta(days=int(n))


def date_part(date_time: str | Column) -> Column:
    """``substring(dateTime, 1, 10)``: the date text of a ``yyyy-MM-dd HH:mm:ss`` string (F1)."""
    return F.substring(_c(date_time), 1, 10)


def time_part(date_time: str | Column) -> Column:
    """``substring(dateTime, 12, 8)``: the clock text (F1)."""
    return F.substring(_c(date_time), 12, 8)


def hour_of(ts: str | Column) -> Column:
    """Hour of day 0-23."""
    return F.hour(_c(ts))


def epoch_seconds_ntz_sql(ts: str) -> str:
    """SQL: whole seconds since 1970-01-01 of a wall-clock timestamp, independent of the session
    time zone (used for ``timeKey``)."""
    return (f"(CAST(datediff(to_date({ts}), DATE'1970-01-01') AS BIGINT) * 86400 "
            f"+ hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))")


def epoch_seconds_ntz(ts: str | Column) -> Column:
    """Column form of ``epoch_seconds_ntz_sql``."""
    if isinstance(ts, str):
        return F.expr(epoch_seconds_ntz_sql(f"`{ts}`"))
    t = ts
    days = F.datediff(F.to_date(t), F.lit(_EPOCH))
    return (days.cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
            + F.second(t)).cast("bigint")


def _shapes(fmt: str) -> tuple[str, list[str]]:
    """(kind, shapes) of a form: its text with 9 for digits, A and a for letters."""
    if fmt == "epoch":
        return "seconds", ["9" * n for n in (9, 10, 11)]
    if fmt == "epoch_ms":
        return "millis", ["9" * 13]
    plain = fmt.replace("'T'", "A").replace("XXX", "").replace("MMM", "Aaa")
    shape = "".join("9" if c in "yMdHms" else c for c in plain.replace("Aaa", "\0")).replace("\0", "Aaa")
    if fmt.endswith("XXX"):
        return "zoned", [shape + z for z in ("A", "+99:99", "-99:99", "+9999", "-9999")]
    return ("named" if "MMM" in fmt else "dotted" if fmt.startswith("dd.") else "iso" if "ss" in fmt else "short"), [shape]


def lenient_epoch_sql(date_time: str, formats: tuple[str, ...] = LENIENT_FORMATS) -> str:
    """SQL: parse text to epoch seconds, 0 when nothing parses.

    Mirrors a "best effort, zero on failure" parse: text in none of the forms becomes the epoch, so two broken
    values compare equal. A text is mapped to its shape (digits and letters replaced by one of their kind), a
    small table says what form a shape has, and one parse follows: the form is brought to ISO order and cast, which
    neither throws nor builds a formatter. Times without a zone count as UTC and those with one as the instant that they
    name, so the result does not depend on the session time zone. A fraction of a second is dropped."""
    d = date_time
    kinds = [(shape, kind) for kind, shapes in map(_shapes, formats) for shape in shapes]
    table = "map(" + ", ".join(f"'{shape}', '{kind}'" for shape, kind in kinds) + ")"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    shape = f"translate({d}, '0123456789{letters}{letters.lower()}', '{'9' * 10}{'A' * 26}{'a' * 26}')"
    kind = f"try_element_at({table}, regexp_replace({shape}, '(:99)[.]9+', '$1'))"
    months = "map(" + ", ".join(f"'{m}', '{i:02d}'" for i, m in enumerate(_MONTHS, 1)) + ")"
    iso = f"""CASE {kind} WHEN 'iso' THEN concat(substr({d}, 1, 19), 'Z') WHEN 'zoned' THEN {d}
        WHEN 'short' THEN concat({d}, ':00Z')
        WHEN 'dotted' THEN concat(substr({d}, 7, 4), '-', substr({d}, 4, 2), '-', substr({d}, 1, 2), substr({d}, 11, 9), 'Z')
        WHEN 'named' THEN concat(substr({d}, 8, 4), '-', try_element_at({months}, substr({d}, 4, 3)), '-', substr({d}, 1, 2),
                                 substr({d}, 12, 9), 'Z') END"""
    found = [f"unix_seconds(try_cast({iso} AS TIMESTAMP))"]
    if any(k in ("seconds", "millis") for _, k in kinds):
        found.append(f"CASE {kind} WHEN 'seconds' THEN try_cast({d} AS BIGINT) "
                     f"WHEN 'millis' THEN try_cast(substr({d}, 1, 10) AS BIGINT) END")
    return f"coalesce({', '.join(found)}, CAST(0 AS BIGINT))"


def lenient_epoch(date_time: str, formats: tuple[str, ...] = LENIENT_FORMATS) -> Column:
    """Column form of ``lenient_epoch_sql`` for a column name."""
    return F.expr(lenient_epoch_sql(f"`{date_time}`", formats))
