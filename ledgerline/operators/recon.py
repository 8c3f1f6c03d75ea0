"""Stream-to-stream reconciliation: records of one stream with no counterpart in another.

Two removal levels are supported, as the two daily checks use them:

* ``unmatched_by_second`` (first level): a source record goes when some source record with the
  same four keys **and the same dateTime text** matches a counterpart record (J1, J3). The unit of
  removal is key + second, not the record: a twin with the same key and second but another
  duration goes with its matched twin.
* ``unmatched_by_key`` (key level): a source record goes when **any** record of its key matched,
  whatever its time (J2, J4).

A match is: the four keys equal, ``|duration difference| < tol.duration`` and
``|time difference + shift| < tol.seconds`` for one of ``tol.shifts`` (clock one hour off either way
for the key level). Comparisons are strict, in signed integers.

Both removals are ``left_anti`` joins. The source dialect's left join fills unmatched right-side
columns with ``''``/``0`` and the original SQL relies on that fill (``where key != keyPass``); with
SQL NULLs the literal form returns nothing, so the anti join is the meaning, not a rewrite. A NULL
key never matches, so such a record is reported as unmatched.

Scale: the match is an existence test, so it is a ``left_semi`` join, never a pair list. Its
equi keys are the four call keys **plus a time bucket** of the next power of two from ``2 * tol.seconds``: a left row is
copied into the (at most two) buckets its tolerance window touches, and the rows of one side (the
smaller, by default the source) once per clock shift. Each join group is then one subscriber within a few seconds, so a hot subscriber
holding a third of all records spreads over many groups and tasks instead of one quadratic
group; AQE's skew-join split handles what remains. A broadcast is used only when the caller has
proved the source side small (``broadcast_left``, decided in ``checks`` from an exact row count or
the cap bound and the measured row width): the counterpart then streams past it unshuffled.
Otherwise Spark broadcasts a side only when its measured size is under its own threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CALL_KEY
from ..functions.text import quote_ident as _q

_T = "_t"          # comparable time (seconds) of a row
_B = "_bucket"     # time bucket used as an extra equi key
_D = "_dur"        # duration used in the residual test


@dataclass(frozen=True)
class Tolerance:
    """Match tolerances: strict bounds on the duration and time differences, and the clock
    shifts (seconds) under which two times may also count as equal."""
    duration: int = 3
    seconds: int = 3
    shifts: tuple[int, ...] = (0,)

    @property
    def bucket_bits(self) -> int:
        # a window [t - s, t + s] of width 2s touches at most two buckets of width 2 ** bits >= 2s
        return max(2 * int(self.seconds) - 1, 0).bit_length()


SAME_SECOND = Tolerance(3, 3, (0,))
HOUR_SHIFT = Tolerance(3, 3, (0, 3600, -3600))


def _bucket(t: str, bits: int) -> str:
    """``floor(t / 2 ** bits)``, negatives included. A shift of a time that is never NULL is never NULL either, so Spark
    drops the join's ``isnotnull(_bucket)``; of a division it would copy the filter, and with it the whole
    parse of the time, below every projection down to the scan."""
    return f"shiftright({t}, {bits})"


def left_rows(df: DataFrame, keys: Sequence[str], time: str, duration: str,
               tol: Tolerance, carry: Sequence[str], shifts: Sequence[int] = (0,)) -> DataFrame:
    """Left rows with their comparable time (shifted, once per shift in ``shifts``) and each bucket
    the tolerance window of that time touches."""
    w, s = tol.bucket_bits, int(tol.seconds)
    cols = [_q(c) for c in dict.fromkeys([*keys, *carry])]
    base = df.selectExpr(*cols, f"{_q(duration)} AS {_D}", f"CAST({time} AS BIGINT) AS {_T}")
    if list(shifts) != [0]:
        base = (base.selectExpr("*", f"explode(array({', '.join(str(k) for k in shifts)})) AS _shift")
                .selectExpr(*cols, _D, f"{_T} + _shift AS {_T}"))
    return base.selectExpr("*", f"explode(array_distinct(array({_bucket(f'{_T} - {s}', w)}, "
                                f"{_bucket(f'{_T} + {s}', w)}))) AS {_B}")


def right_rows(df: DataFrame, keys: Sequence[str], time: str, duration: str,
                tol: Tolerance, carry: Sequence[str] = (), shifts: Sequence[int] = (0,)) -> DataFrame:
    """Right rows, once per shift in ``shifts``, with the shifted time and its bucket. A left time
    ``t1`` matches under shift ``k`` when ``|t1 + k - t2| < s``, i.e. ``|t1 - (t2 - k)| < s``."""
    w = tol.bucket_bits
    cols = [_q(c) for c in dict.fromkeys([*keys, *carry])]
    base = df.selectExpr(*cols, f"{_q(duration)} AS {_D}", f"CAST({time} AS BIGINT) AS _t0")
    if list(shifts) == [0]:
        return base.selectExpr(*cols, _D, f"_t0 AS {_T}", f"{_bucket('_t0', w)} AS {_B}")
    return (base.selectExpr("*", f"explode(array({', '.join(str(k) for k in shifts)})) AS _shift")
            .selectExpr(*cols, _D, f"_t0 - _shift AS {_T}", f"{_bucket('_t0 - _shift', w)} AS {_B}"))


def _sides(left, right, keys, left_time, right_time, duration, tol, left_carry, right_carry,
           shift_on):
    shifts = list(dict.fromkeys(int(k) for k in tol.shifts))
    if shift_on not in ("left", "right"):
        raise ValueError("shift_on is 'left' or 'right'")
    ls, rs = (shifts, [0]) if shift_on == "left" else ([0], shifts)
    l = left_rows(left, keys, left_time, duration, tol, left_carry, ls).alias("l")
    r = right_rows(right, keys, right_time, duration, tol, right_carry, rs).alias("r")
    return l, r


def condition(keys: Sequence[str], tol: Tolerance) -> Column:
    eq = [f"l.{_q(k)} = r.{_q(k)}" for k in [*keys, _B]]
    return F.expr(" AND ".join(eq + [f"abs(l.{_D} - r.{_D}) < {int(tol.duration)}",
                                     f"abs(l.{_T} - r.{_T}) < {int(tol.seconds)}"]))


def matched_left(left: DataFrame, right: DataFrame, *, tol: Tolerance,
                 left_time: str, right_time: str,
                 keys: Sequence[str] = CALL_KEY, duration: str = "duration",
                 carry: Sequence[str] = (), shift_on: str = "left",
                 broadcast_left: bool = False) -> DataFrame:
    """Left rows (``keys`` + ``carry`` columns) that have at least one matching right row.
    ``left_time``/``right_time`` are SQL expressions giving seconds (e.g. ``"timeKey"``).

    ``shift_on`` names the side copied once per clock shift; put the shifts on the smaller side
    (by default the left, the one check's day of source records, against a counterpart of several
    days of all records). A left row may come out more than once (once per copy that found a
    match); callers reduce the result to the distinct removal units they need.

    ``broadcast_left`` is for a left side whose size has a proven bound (the capped source): the
    right side then streams past a broadcast of the left in an inner join, and is never shuffled.
    A semi join cannot broadcast its left side, hence the inner join; its output is one row per
    matching pair within the tolerance, reduced by the caller's ``DISTINCT``."""
    l, r = _sides(left, right, keys, left_time, right_time, duration, tol, carry, (), shift_on)
    out_cols = [f"l.{_q(c)}" for c in dict.fromkeys([*keys, *carry])]
    if broadcast_left:
        return r.join(F.broadcast(l), condition(keys, tol), "inner").selectExpr(*out_cols)
    return l.join(r, condition(keys, tol), "left_semi").selectExpr(*out_cols)


def matched_pairs(left: DataFrame, right: DataFrame, *, tol: Tolerance,
                  left_time: str, right_time: str,
                  keys: Sequence[str] = CALL_KEY, duration: str = "duration",
                  left_cols: Sequence[str] = ("duration", "dateTime"),
                  right_cols: Sequence[str] = ("dateTime",),
                  right_prefix: str = "r_", shift_on: str = "left") -> DataFrame:
    """The matched pairs themselves (J1 as an inner join): keys, ``left_cols`` of the left row and
    ``right_cols`` of the right row (prefixed). Distinct, as the original lists them. Only pairs
    within the tolerance are produced, found through the same bucketed equi join."""
    l, r = _sides(left, right, keys, left_time, right_time, duration, tol, list(left_cols),
                  list(right_cols), shift_on)
    cols = ([f"l.{_q(k)}" for k in keys] + [f"l.{_q(c)}" for c in left_cols if c not in keys]
            + [f"r.{_q(c)} AS {_q(right_prefix + c)}" for c in right_cols])
    return l.join(r, condition(keys, tol), "inner").selectExpr(*cols).distinct()


def counterpart_candidates(counterpart: DataFrame, source: DataFrame, key: str = "IMSI") -> DataFrame:
    """Counterpart rows whose ``key`` occurs in the source (``key IN (select key ...)``, P5).

    A ``left_semi`` join against the distinct source keys: the distinct is a partial aggregation
    that shrinks the shuffled side to one row per key per task, and the join reuses its
    partitioning. Unlike ``NOT IN``/``IN`` rewrites this is NULL-safe (a NULL key never matches)."""
    keys = source.select(key).distinct()
    return counterpart.join(keys, key, "left_semi")


def unmatched_by_second(source: DataFrame, counterpart: DataFrame, *,
                        tol: Tolerance = SAME_SECOND, time_sql=None,
                        keys: Sequence[str] = CALL_KEY, second_col: str = "dateTime",
                        duration: str = "duration", broadcast_source: bool = False) -> DataFrame:
    """First-level removal (J1 + J3): source rows minus every (keys, ``second_col``) unit that has a
    matched row. ``time_sql(expr)`` turns ``second_col`` into comparable seconds (default: lenient
    parse of ``yyyy-MM-dd HH:mm:ss``, epoch when unparseable, so two broken values match).

    Returns all source columns; rows are not deduplicated here (the caller projects, then
    deduplicates the output columns once). ``broadcast_source`` only for a source with a proven
    size bound (see ``matched_left``).

    Not built on purpose: in the original, an *unmatched* record with an unparseable time and a
    duration under 3 removes itself through the type-default fill of its outer join; that is an
    accident of the fill, not a rule.
    """
    if time_sql is None:
        from ..functions.datetime import lenient_epoch_sql
        time_sql = lenient_epoch_sql
    unit = [*keys, second_col]
    t = time_sql(_q(second_col))
    matched = matched_left(source, counterpart, tol=tol, keys=keys, duration=duration,
                           left_time=t, right_time=t, carry=[second_col],
                           broadcast_left=broadcast_source)
    # one row per removal unit (partial aggregation; the anti join reuses its partitioning). The
    # anti join is partitioned by (keys, second), so a hot subscriber spreads over its seconds.
    return source.join(matched.distinct(), unit, "left_anti").select(*[_q(c) for c in source.columns])


def unmatched_by_key(source: DataFrame, counterpart: DataFrame, *,
                     tol: Tolerance = HOUR_SHIFT, time_col: str = "timeKey",
                     keys: Sequence[str] = CALL_KEY, duration: str = "duration",
                     concat_key: bool = False, shift_on: str = "left",
                     broadcast_source: bool = False, match_source: DataFrame | None = None) -> DataFrame:
    """Key-level removal (J2 + J4): source rows whose key has no matched record at all.

    ``concat_key=True`` compares the keys glued together without a separator, as the original
    does (so ``('1','23')`` equals ``('12','3')``); the default compares the columns.

    ``match_source`` is what the match reads instead of ``source``: the same records with only the match columns,
    when ``source`` is wide or deduplicated over more columns.

    The matched keys are reduced to one row per key before the anti join. Nothing after the anti
    join should depend on its key partitioning (deduplicate the source first, as
    ``checks.key_level_unmatched`` does): then AQE is free to split the partition of a hot key
    across tasks."""
    matched = matched_left(source if match_source is None else match_source, counterpart, tol=tol, keys=keys,
                           duration=duration, left_time=_q(time_col), right_time=_q(time_col), shift_on=shift_on,
                           broadcast_left=broadcast_source)
    if concat_key:
        glued = f"concat({', '.join(_q(k) for k in keys)})"
        mk = matched.selectExpr(f"{glued} AS _key").distinct()
        out = source.selectExpr("*", f"{glued} AS _key").join(mk, "_key", "left_anti")
    else:
        out = source.join(matched.distinct(), list(keys), "left_anti")
    return out.select(*[_q(c) for c in source.columns])        # a join on names puts them first
