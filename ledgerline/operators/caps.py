"""Volume caps of the first-level reconciliation.

When the day's source volume reaches a trigger, the original job keeps at most ``per_group`` rows per
hour of day and at most ``total`` rows overall, and marks the capped output (``'!'`` before the input
file name). The caps cut rows, so they are opt-in here; nothing applies them unless a ``CapRule`` is
passed. The original limits have no ORDER BY, so which rows survive is arbitrary there; here the order
is total (``eventDateTime, record_id``; rows equal in both are exact copies), so a rerun or a
recomputation after a lost executor picks the same rows, and the capped set used twice in the plan is
the same set.

Scale notes:

* The decision is one filtered ``count`` (partial counts per task, one number to the driver).
* ``cut_by_hour`` counts rows per (hour, second) of the day with partial aggregation: at most 86,400
  rows, whatever the day holds. From them the driver finds, for each hour, the second in which its limit
  falls. Rows before it are kept by a literal filter, without a shuffle; only the rows of the cut seconds are
  ranked, with a salt, so a second that holds a third of the day is ranked by many tasks. The plan does not
  depend on a limit being small enough for ``WindowGroupLimit``. The total cap is the same filter with
  smaller limits for the last hours.
* ``limit_by`` is the general per-group top-n, a two-level top-n: first per (group, salt), then per group.
  Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) rows a group Spark trims every group inside the
  map tasks; above it the first level sorts all rows, spread over groups times ``fanout`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CAP_PER_HOUR, CAP_TOTAL, CAP_TRIGGER_ROWS

RANK_COL = "_rank_in_group"
#: groups that ``limit_total`` may count on the driver
MAX_GROUPS = 100_000


@dataclass(frozen=True)
class CapPlan:
    """Outcome of the cap decision: ``per_group``/``total`` are ``None`` when no cap applies.
    ``day_rows`` is the count the decision was taken on; ``source_rows``, when known, all rows
    the cap applies to; ``row_bytes``, when known, the widest row of the matched text columns."""
    day_rows: int
    per_group: int | None
    total: int | None
    source_rows: int | None = None
    row_bytes: int | None = None   # widest row of the matched columns, when measured

    @property
    def on(self) -> bool:
        return self.per_group is not None or self.total is not None


def decide(day_rows: int, *, trigger: int, per_group: int, total: int, source_rows: int | None = None,
           row_bytes: int | None = None) -> CapPlan:
    """The cap decision for a counted day."""
    on = day_rows >= trigger
    return CapPlan(day_rows, int(per_group) if on else None, int(total) if on else None,
                   source_rows=source_rows, row_bytes=row_bytes)


def cap_decision(counted: DataFrame, *, trigger: int = CAP_TRIGGER_ROWS,
                 per_group: int = CAP_PER_HOUR, total: int = CAP_TOTAL) -> CapPlan:
    """Count ``counted`` (already filtered to the rows that decide, e.g. shoulder 1) and decide.

    The original wraps the count in a NULL default; a count is never NULL, so the default can
    never apply and is not modelled."""
    return decide(counted.count(), trigger=trigger, per_group=per_group, total=total)


def _second_counts(df: DataFrame, time_col: str) -> dict:
    """hour -> sorted [(second, rows)], NULL first: at most 86,400 entries for a day of rows."""
    sec = F.date_trunc("second", F.col(time_col)).cast("timestamp_ntz")
    rows = (df.groupBy(F.hour(time_col).alias("h"), sec.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect())
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r["s"] is not None, r["s"])):
        out.setdefault(r["h"], []).append((r["s"], r["n"]))
    return out


def cut_by_hour(df: DataFrame, n: int, *, total: int | None = None, time_col: str = "eventDateTime",
                order_cols: Sequence[str] = ("eventDateTime", "record_id"), fanout: int = 32) -> DataFrame:
    """The first ``n`` rows of every hour of a day by ``order_cols`` (which start with ``time_col``), and of these
    the first ``total`` in (hour, order). Rows without a time are a group of their own, first in order."""
    counts = _second_counts(df, time_col)
    left = float("inf") if total is None else int(total)
    keep, cuts = [], []                      # SQL conditions; (condition of the cut second, rows to keep of it)
    for hour in sorted(counts, key=lambda h: (h is not None, h)):
        limit = min(int(n), left)
        held = min(limit, sum(c for _, c in counts[hour]))
        left -= held
        of_hour = "_h IS NULL" if hour is None else f"_h = {hour}"
        before = 0
        cut = None
        for second, c in counts[hour]:
            if before + c > limit:
                cut = (second, limit - before)
                break
            before += c
        if cut is None:
            keep.append(of_hour)
            continue
        second, rest = cut
        if second is not None:
            keep.append(f"({of_hour} AND _s < TIMESTAMP_NTZ'{second}')")
        if rest:
            same = "_s IS NULL" if second is None else f"_s = TIMESTAMP_NTZ'{second}'"
            cuts.append((f"({of_hour} AND {same})", int(rest)))
    sec = F.date_trunc("second", F.col(time_col)).cast("timestamp_ntz")
    timed = df.withColumn("_h", F.hour(time_col)).withColumn("_s", sec)
    whole = timed.where(" OR ".join(keep) if keep else "FALSE")
    if cuts:
        rest = "CASE " + " ".join(f"WHEN {c} THEN {k}" for c, k in cuts) + " END"
        order = [F.col(o) for o in order_cols]
        salt = F.pmod(F.xxhash64(*order), F.lit(int(fanout)))
        at_cut = timed.where(" OR ".join(c for c, _ in cuts)).withColumn("_k", F.expr(rest))
        for group in ([F.col("_h"), salt], [F.col("_h")]):
            rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
            at_cut = at_cut.withColumn("_r", rank).where("_r <= _k").drop("_r")
        whole = whole.unionByName(at_cut.drop("_k"))
    return whole.drop("_h", "_s")


def limit_by(df: DataFrame, group_cols: Sequence[str | Column], order_cols: Sequence[str | Column],
             n: int, *, fanout: int = 32, keep_rank: bool = False) -> DataFrame:
    """First ``n`` rows of every group by ``order_cols`` (``limit n by group``).

    ``order_cols`` must give a total order up to identical rows, or the kept set is not
    repeatable. With ``keep_rank`` the 1-based rank within the group stays as ``_rank_in_group``."""
    n = int(n)
    groups = [F.col(g) if isinstance(g, str) else g for g in group_cols]
    order = [F.col(o) if isinstance(o, str) else o for o in order_cols]
    out = df
    if fanout and fanout > 1:
        salt = F.pmod(F.xxhash64(*order), F.lit(int(fanout)))
        w1 = Window.partitionBy(*groups, salt).orderBy(*order)
        out = out.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n).drop("_r1")
    w2 = Window.partitionBy(*groups).orderBy(*order)
    out = out.withColumn(RANK_COL, F.row_number().over(w2)).where(F.col(RANK_COL) <= n)
    return out if keep_rank else out.drop(RANK_COL)


def limit_total(ranked: DataFrame, group_col: str, total: int) -> DataFrame:
    """Keep the first ``total`` rows in the order (``group_col``, in-group rank).

    ``ranked`` must carry ``_rank_in_group`` (``limit_by(..., keep_rank=True)``) and ``group_col``
    must be an orderable value with few distinct values (hour of day, at most ``MAX_GROUPS``). Exact, with no
    global sort: one count per group goes to the driver."""
    total = int(total)
    rows = ranked.groupBy(group_col).count().limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{group_col} has more than {MAX_GROUPS} values; a total limit needs a coarse group")
    # NULL groups sort first in an ascending order
    counts = [(None, c) for g, c in rows if g is None] + sorted((g, c) for g, c in rows if g is not None)
    remaining = total
    keep_full: list = []
    cut_group, cut_rank = None, None
    for g, c in counts:
        if remaining <= 0:
            break
        if c <= remaining:
            keep_full.append(g)
            remaining -= c
        else:
            cut_group, cut_rank = g, remaining
            remaining = 0
    if cut_rank is None and len(keep_full) == len(counts):
        return ranked

    def is_group(g):
        return F.col(group_col).isNull() if g is None else F.col(group_col) == F.lit(g)

    cond = F.lit(False)
    for g in keep_full:
        cond = cond | is_group(g)
    if cut_rank is not None:
        cond = cond | (is_group(cut_group) & (F.col(RANK_COL) <= F.lit(cut_rank)))
    return ranked.where(cond)


def mark_capped(c: str | Column, cap: CapPlan, marker: str = "!") -> Column:
    """``if(cap on, concat('!', f), f)``: flag output that a cap may have cut."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(marker), col) if cap.on else col


def mark_capped_sql(name: str, cap: CapPlan, marker: str = "!") -> str:
    """SQL form of ``mark_capped`` for a column name."""
    return f"concat('{marker}', `{name}`)" if cap.on else f"`{name}`"


def apply_caps(df: DataFrame, cap: CapPlan, *, order_cols: Sequence[str] = ("eventDateTime", "record_id"),
               fanout: int = 32) -> DataFrame:
    """Per-hour and total caps of the first-level check on a day of source rows. The total cap counts
    in (hour, eventDateTime, record_id) order."""
    if not cap.on:
        return df
    per = cap.total if cap.per_group is None else cap.per_group
    return cut_by_hour(df, per, total=cap.total, time_col=order_cols[0], order_cols=order_cols, fanout=fanout)
