"""Text, path and ordering expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_ident(name: str) -> str:
    """A column name as a SQL identifier (back-quoted)."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(v) -> str:
    """A value as a SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


_q = quote_ident
_sql_text = sql_string


def list_rank(c: str | Column, values: Sequence[str], unknown: str = "") -> Column:
    """Rank of a value in a fixed list as text ``'0'``, ``'1'``, ...; anything else gets
    ``unknown`` (``''`` sorts before every digit, so unknown values come first) (W5)."""
    if isinstance(c, str):
        whens = " ".join(f"WHEN {_sql_text(v)} THEN '{i}'" for i, v in enumerate(values))
        return F.expr(f"CASE {_q(c)} {whens} ELSE {_sql_text(unknown)} END")
    expr = F.lit(unknown)
    for i in range(len(values) - 1, -1, -1):
        expr = F.when(c == F.lit(values[i]), F.lit(str(i))).otherwise(expr)
    return expr


def list_ordinal(c: str | Column, values: Sequence[str]) -> Column:
    """Replace each listed value with its two-digit 1-based position; others stay as they are
    (F15, W7)."""
    if isinstance(c, str):
        whens = " ".join(f"WHEN {_sql_text(v)} THEN '{i + 1:02d}'" for i, v in enumerate(values))
        return F.expr(f"CASE {_q(c)} {whens} ELSE {_q(c)} END")
    expr = c
    for i in range(len(values) - 1, -1, -1):
        expr = F.when(c == F.lit(values[i]), F.lit(f"{i + 1:02d}")).otherwise(expr)
    return expr


def any_of_pattern(words: Sequence[str]) -> str:
    """A case-insensitive regex matching any of the words anywhere (P10)."""
    return "(?i)(" + "|".join(_escape(w) for w in words) + ")"


def _escape(w: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in w)


def matches_any(c: str | Column, words: Sequence[str]) -> Column:
    """``-match "A|B|C"``: case-insensitive, anywhere in the text (P10)."""
    return _c(c).rlike(any_of_pattern(words))


def eligible_file_name(name: str | Column, suffix: str, excludes: Sequence[str]) -> Column:
    """Ends with ``suffix`` and contains none of ``excludes`` (case-sensitive)."""
    n = _c(name)
    cond = n.endswith(suffix)
    for x in excludes:
        cond = cond & ~n.contains(x)
    return cond


def last_component(path: str | Column) -> Column:
    """File name of a ``/``- or ``\\``-separated path."""
    return F.regexp_extract(_c(path), r"([^/\\]*)$", 1)


def parent_dir(path: str | Column) -> Column:
    """Directory part of a path, without the trailing separator."""
    return F.regexp_extract(_c(path), r"^(.*)[/\\][^/\\]*$", 1)


def path_segment_matching(path: str | Column, words: Sequence[str]) -> Column:
    """The first path segment equal (case-insensitively) to one of ``words``, as written in
    the path; replaces fixed character offsets (F14)."""
    alts = "|".join(_escape(w) for w in words)
    return F.regexp_extract(_c(path), r"(?i)(?:^|[/\\])(" + alts + r")(?=[/\\]|$)", 1)


def strip_backslashes(c: str | Column) -> Column:
    """Remove backslashes, as the short status text does."""
    return F.regexp_replace(_c(c), r"\\", "")
