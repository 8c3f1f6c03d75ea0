"""The two daily reconciliation checks, composed from filters, caps and the removal joins.

Repairs of the damaged original text that change meaning are taken as follows (each is a
judgement, noted here so it can be revisited): the capped output is marked when the cap is **on**
(``if(lim = 10000, ...)``; literally the slipped ``lim-10000`` would mark the uncapped rows);
``where 1-1`` of the key-level check is read as ``where 1=1``; ``INST`` is ``IMSI``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (CALL_KEY, CAP_PER_HOUR, CAP_TOTAL, CAP_TRIGGER_ROWS, FIRST_LEVEL_CHECK,
                         FIRST_LEVEL_COLUMNS, KEY_LEVEL_CHECK, KEY_LEVEL_COLUMNS, KEY_LEVEL_LAG_DAYS,
                         KEY_LEVEL_LAG_DAYS_STH, NO_CAP)
from ..functions.datetime import LENIENT_FORMATS, days_before, lenient_epoch_sql
from ..functions.text import sql_string as _lit
from .caps import CapPlan, apply_caps, decide, mark_capped_sql
from .recon import (HOUR_SHIFT, SAME_SECOND, Tolerance, counterpart_candidates, matched_pairs,
                    unmatched_by_key, unmatched_by_second)


@dataclass(frozen=True)
class CapRule:
    """Cap parameters of the first-level check; ``None`` switches caps off."""
    trigger: int = CAP_TRIGGER_ROWS
    per_hour: int = CAP_PER_HOUR
    total: int = CAP_TOTAL
    fanout: int = 32


@dataclass(frozen=True)
class BroadcastRule:
    """When to broadcast the (possibly capped) source of a reconciliation match.

    Before the plan is built, one aggregation over the source day counts its rows and measures its
    widest row (bytes of the key and text columns the broadcast side carries); with a cap on, the
    rows are further bounded by ``min(total, 25 * per_hour)`` (24 hours and NULL). The broadcast
    side then holds at most ``rows * copies * (fixed_row_bytes + widest text bytes)`` bytes, where
    ``copies`` counts time buckets and clock shifts and ``fixed_row_bytes`` covers the row header
    and the numeric columns with room for the hash table. Within ``max_bytes`` the counterpart
    streams past a broadcast of the source and is never shuffled; otherwise both sides are
    shuffled on (keys, time bucket). A semi join cannot broadcast its left side, so Spark would not
    choose this plan by itself."""
    fixed_row_bytes: int = 128
    max_bytes: int = 128 * 1024 * 1024

    def allows(self, rows: int, copies: int = 2, text_bytes: int = 0) -> bool:
        return rows * copies * (self.fixed_row_bytes + int(text_bytes or 0)) <= self.max_bytes


def _text_bytes(cols) -> F.Column:
    """Bytes of the given columns of one row (NULL counts 0)."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
    return total


def lag_for(dictionary: DataFrame, check: str, attr: str = "days_before") -> int:
    """``dictGet(dict, attr, check)``: one attribute of one check, a single scalar."""
    row = dictionary.where(F.col("cpName") == F.lit(check)).select(attr).first()
    if row is None:
        raise KeyError(f"check {check!r} is not in the dictionary")
    return int(row[0])


def first_level_source(start: DataFrame, day: _dt.date, check: str = FIRST_LEVEL_CHECK) -> DataFrame:
    """Source rows of one check and day, flag 0 (P1, P2). Literal filters: they reach the scan
    (partition pruning when ``eventDate`` is the partition column)."""
    return start.where(f"eventDate = DATE'{day.isoformat()}' AND cpName = {_lit(check)} AND iflag = 0")


def first_level_cap(source_day: DataFrame, rule: CapRule | None) -> CapPlan:
    """The cap decision counts shoulder-1 rows only (A1, A4, P9); the same aggregation counts all
    source rows of the day and measures the widest row the match carries (keys + dateTime), for
    the broadcast size check."""
    row = source_day.agg(F.count(F.lit(1)).alias("n"),
                         F.count(F.when(F.col("shoulder") == 1, 1)).alias("n1"),
                         F.max(_text_bytes([*CALL_KEY, "dateTime"])).alias("w")).first()
    n_all, n1, width = int(row["n"]), int(row["n1"]), int(row["w"] or 0)
    if rule is None:
        return CapPlan(n1, None, None, source_rows=n_all, row_bytes=width)
    return decide(n1, trigger=rule.trigger, per_group=rule.per_hour, total=rule.total, source_rows=n_all,
                  row_bytes=width)


def capped_rows_bound(cap: CapPlan) -> int:
    """Most rows the capped source can have."""
    bound = cap.source_rows if cap.source_rows is not None else NO_CAP
    if cap.per_group is not None:
        bound = min(bound, 25 * cap.per_group)
    if cap.total is not None:
        bound = min(bound, cap.total)
    return bound


def first_level_capped(start: DataFrame, as_of, *, days_back: int, check: str = FIRST_LEVEL_CHECK,
                       caps: CapRule | None = None,
                       count_rows: bool = False) -> tuple[DataFrame, CapPlan]:
    """The (possibly capped) source rows of the first-level check and the cap decision. Without
    caps and without ``count_rows`` no count job runs. The cap filters by literals, so both uses of
    the capped set read the same rows without keeping it anywhere."""
    day = days_before(as_of, days_back)
    src = first_level_source(start, day, check)
    cap = first_level_cap(src, caps) if (caps is not None or count_rows) else CapPlan(0, None, None)
    return apply_caps(src, cap, fanout=caps.fanout if caps else 32), cap


def first_level_unmatched(start: DataFrame, rnd: DataFrame, as_of, *, days_back: int,
                          check: str = FIRST_LEVEL_CHECK, caps: CapRule | None = None,
                          tol: Tolerance = SAME_SECOND, reduce_by_imsi: bool = False,
                          broadcast: BroadcastRule | None = None,
                          formats: tuple[str, ...] = LENIENT_FORMATS) -> DataFrame:
    """First-level check: source records of the day with no counterpart, removed by key + second.

    Caps are off unless a ``CapRule`` is given. ``formats`` are the text forms of ``dateTime`` (see
    ``lenient_epoch_sql``). Without caps and without a ``BroadcastRule`` no count job runs.

    ``reduce_by_imsi`` adds the original ``IMSI IN (...)`` reduction of the counterpart (against the
    uncapped source, as written). It never changes the result, since the match joins on IMSI; on a
    cluster Spark's runtime bloom filter usually gives the same reduction for free. When the
    (capped) source is small enough to broadcast (``BroadcastRule``), the match streams the
    counterpart past the broadcast source and the reduction is skipped.
    """
    day = days_before(as_of, days_back)
    capped, cap = first_level_capped(start, as_of, days_back=days_back, check=check, caps=caps,
                                     count_rows=broadcast is not None)
    capped = capped.selectExpr("*", "substring(dateTime, 1, 10) AS date",
                               "substring(dateTime, 12, 8) AS time")
    counter = rnd.where(f"eventDate = DATE'{day.isoformat()}'")
    bounded = broadcast is not None and broadcast.allows(capped_rows_bound(cap),
                                                         copies=2 * len(set(tol.shifts)),
                                                         text_bytes=cap.row_bytes)
    if reduce_by_imsi and not bounded:
        # with a broadcast source the join itself filters the counterpart by key, without a shuffle
        counter = counterpart_candidates(counter, first_level_source(start, day, check))
    left = unmatched_by_second(capped, counter, tol=tol, broadcast_source=bounded,
                               time_sql=lambda c: lenient_epoch_sql(c, formats))
    cols = [f"{mark_capped_sql('inputFileName', cap)} AS inputFileName" if c == "inputFileName"
            else f"`{c}`" for c in FIRST_LEVEL_COLUMNS]
    return left.selectExpr(*cols).distinct()


def first_level_pairs(start: DataFrame, rnd: DataFrame, as_of, *, days_back: int,
                      check: str = FIRST_LEVEL_CHECK, caps: CapRule | None = None,
                      tol: Tolerance = SAME_SECOND,
                      formats: tuple[str, ...] = LENIENT_FORMATS) -> DataFrame:
    """Matched pairs of the first-level check (J1 as an inner join): the source key, duration and
    dateTime with the counterpart's dateTime as ``dateTime2``."""
    day = days_before(as_of, days_back)
    capped, _ = first_level_capped(start, as_of, days_back=days_back, check=check, caps=caps,
                                   count_rows=False)
    counter = rnd.where(f"eventDate = DATE'{day.isoformat()}'")
    t = lenient_epoch_sql("dateTime", formats)
    return matched_pairs(capped, counter, tol=tol, left_time=t,
                         right_time=t, left_cols=("duration", "dateTime"),
                         right_cols=("dateTime",), right_prefix="r_").withColumnRenamed(
        "r_dateTime", "dateTime2")


def key_level_days(as_of, lag: int, lag_sth: int) -> tuple[_dt.date, _dt.date]:
    return days_before(as_of, lag), days_before(as_of, lag_sth)


def key_level_source(start: DataFrame, as_of, *, check: str = KEY_LEVEL_CHECK,
                     lag: int = KEY_LEVEL_LAG_DAYS, lag_sth: int = KEY_LEVEL_LAG_DAYS_STH,
                     region_col: str = "MR", sth: str = "Sth") -> DataFrame:
    """Source rows of the key-level check: day ``as_of - lag``, or ``as_of - lag_sth`` for the
    southern region (P3). The implied ``eventDate IN (d, d_sth)`` is stated so it prunes."""
    d, d_sth = key_level_days(as_of, lag, lag_sth)
    target = f"CASE WHEN `{region_col}` = {_lit(sth)} THEN DATE'{d_sth}' ELSE DATE'{d}' END"
    return start.where(f"eventDate IN (DATE'{d}', DATE'{d_sth}') AND eventDate = {target} "
                       f"AND cpName = {_lit(check)} AND iflag = 0")


def key_level_counterpart(rnd: DataFrame, as_of, *, lag: int = KEY_LEVEL_LAG_DAYS,
                          lag_sth: int = KEY_LEVEL_LAG_DAYS_STH, region_col: str = "macroregion",
                          sth: str = "STH") -> DataFrame:
    """Counterpart rows within one day either side of the region's target day (P4). The region
    code is upper case in this table; the comparison is literal, as in the original."""
    d, d_sth = key_level_days(as_of, lag, lag_sth)
    lo, hi = min(d, d_sth) - _dt.timedelta(days=1), max(d, d_sth) + _dt.timedelta(days=1)
    target = f"CASE WHEN `{region_col}` = {_lit(sth)} THEN DATE'{d_sth}' ELSE DATE'{d}' END"
    return rnd.where(f"eventDate BETWEEN DATE'{lo}' AND DATE'{hi}' "
                     f"AND eventDate BETWEEN date_sub({target}, 1) AND date_add({target}, 1)")


def key_level_unmatched(start: DataFrame, rnd: DataFrame, as_of, *, check: str = KEY_LEVEL_CHECK,
                        lag: int = KEY_LEVEL_LAG_DAYS, lag_sth: int = KEY_LEVEL_LAG_DAYS_STH,
                        tol: Tolerance = HOUR_SHIFT, concat_key: bool = False,
                        reduce_by_imsi: bool = False,
                        broadcast: BroadcastRule | None = None) -> DataFrame:
    """Key-level check: source records whose key has no counterpart within the tolerances, one
    hour of clock shift either way allowed (J2, J4, J5).

    The match reads only the key, duration and time of the day's records, distinct; the day is read twice, once
    for the rows to report and once for the match. With ``broadcast``, the source day is counted and its widest key measured first (one scan of
    the pruned, filtered partition); if that passes the size check the counterpart streams past a
    broadcast of the source, otherwise both sides are shuffled on (keys, time bucket)."""
    src = key_level_source(start, as_of, check=check, lag=lag, lag_sth=lag_sth)
    counter = key_level_counterpart(rnd, as_of, lag=lag, lag_sth=lag_sth)
    bounded = False
    if broadcast is not None:
        stats = src.agg(F.count(F.lit(1)).alias("n"), F.max(_text_bytes(CALL_KEY)).alias("w")).first()
        bounded = broadcast.allows(int(stats["n"]), copies=2 * len(set(tol.shifts)),
                                   text_bytes=int(stats["w"] or 0))
    if reduce_by_imsi and not bounded:
        counter = counterpart_candidates(counter, src)
    # DISTINCT first (spread over all output columns, partial aggregation), removal last: the
    # anti join on the key is then the final operator and AQE may split a hot key's partition.
    rows = src.selectExpr(*[f"`{c}`" for c in KEY_LEVEL_COLUMNS]).distinct()
    narrow = src.select(*CALL_KEY, "duration", "timeKey").distinct()
    return unmatched_by_key(rows, counter, tol=tol, concat_key=concat_key, broadcast_source=bounded,
                            match_source=narrow)


def candidates_for_day(start: DataFrame, rnd: DataFrame, as_of, *, days_back: int,
                       check: str = FIRST_LEVEL_CHECK) -> DataFrame:
    """The counterpart set of the first-level check: distinct counterpart rows of the day whose
    IMSI occurs in the day's source (P5)."""
    day = days_before(as_of, days_back)
    counter = rnd.where(f"eventDate = DATE'{day.isoformat()}'")
    src = first_level_source(start, day, check)
    # DISTINCT first, the semi join last: nothing above it fixes its partitioning, so AQE may split a hot IMSI
    return counterpart_candidates(counter.select(*CALL_KEY, "duration", "dateTime").distinct(), src)


def lag_lookup(start: DataFrame, dictionary: DataFrame, as_of) -> DataFrame:
    """For every check of the dictionary, its target day (``as_of - days_before``) and the
    source rows on it (S4 as a join, P2). The dictionary is configuration (one row per check);
    Spark sizes the join; the candidate days are stated as literals so the scan prunes."""
    lags = [(r["cpName"], int(r["days_before"])) for r in dictionary.collect()]
    days = sorted({days_before(as_of, n) for _, n in lags})
    d = dictionary.withColumn("target_date", F.date_sub(F.lit(as_of).cast("date"), F.col("days_before")))
    s = start.where(F.col("eventDate").isin(days)).select("cpName", "eventDate")
    joined = s.join(d, (s["cpName"] == d["cpName"]) & (s["eventDate"] == d["target_date"]), "inner")
    counts = joined.groupBy(d["cpName"]).agg(F.count(F.lit(1)).alias("source_rows"))
    return (d.join(counts, "cpName", "left")
            .select("cpName", "days_before", "target_date",
                    F.coalesce("source_rows", F.lit(0)).cast("bigint").alias("source_rows")))
