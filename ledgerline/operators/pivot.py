"""Statistics pivot and ordered extract.

``stat_pivot`` turns a daily statistics table (date x region x check, one column per metric)
into one row per (region, check, metric) with one column per date, newest first, as the daily
report shows it. All metrics are summed per (region, check, date) in one aggregation; the sums of a
(region, check) are then one array in date order for each metric, with zeros put between the dates it has, and a date column
is the array's element at the date's position. The work per row of the statistics does not depend on the number
of dates, nor the shuffled rows on the number of metrics.

Semantics kept from the original report (a pandas pivot table):
* only region x check pairs that occur in the data appear; rows with a NULL date, region or check
  drop out; a NULL metric counts as 0; a missing date is 0;
* rows whose sum over the date columns is 0 are removed, so +5 and -5 on two days cancel;
* order is region, check, metric ordinal (the metric's position in the fixed list, 01-30).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import REGION_ORDER, STAT_METRICS
from ..functions.text import list_ordinal, list_rank
from ..functions.text import quote_ident as _q
from ..functions.text import sql_string as _lit
from ..session import ensure_checkpoint_dir
from ..sources.tables import local_frame
from .position import with_position

ORDINAL_COL = "_ordinal"


_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _value_type(kinds: Sequence[T.DataType]) -> str:
    """The one type of the value cells that holds every metric: BIGINT when all are whole numbers, an exact
    decimal when some are decimals, DOUBLE only when some metric is itself a floating-point number."""
    if all(type(k) in _DIGITS for k in kinds):
        return "BIGINT"
    if any(not isinstance(k, T.DecimalType) and type(k) not in _DIGITS for k in kinds):
        return "DOUBLE"
    scale = max(k.scale for k in kinds if isinstance(k, T.DecimalType))
    whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else _DIGITS[type(k)] for k in kinds)
    return f"DECIMAL({min(38, whole + scale + 6)}, {scale})"


def _date_text(d) -> str:
    return d.isoformat() if isinstance(d, _dt.date) else str(d)


def stat_pivot(stat: DataFrame, metrics: Sequence[str], dates: Sequence | None = None, *,
               date_col: str = "eventDate", region_col: str = "macroRegion",
               check_col: str = "cpName", metric_order: Sequence[str] = STAT_METRICS,
               type_col: str = "cpType", sort: bool = True, ordinal_col: str | None = None) -> DataFrame:
    """Metrics x region x check in rows, dates (``yyyy-MM-dd``, newest first) in columns.

    ``dates`` limits and orders the date columns; without it they are the distinct dates of the sums, which are written to
    the checkpoint folder and read back (a row per region, check and date), so the statistics are read once either way.
    ``ordinal_col`` names an output column for the metric's two-digit ordinal, so that the order is part of the result.

    A (region, check) is one row of the second aggregation: as many entries as it has dates."""
    base = stat.where(f"{_q(date_col)} IS NOT NULL AND {_q(region_col)} IS NOT NULL "
                      f"AND {_q(check_col)} IS NOT NULL")
    if dates is not None:
        base = base.where(F.col(_q(date_col)).isin(list(dates)))
    vtype = _value_type([stat.schema[m].dataType for m in metrics])
    sums = [F.expr(f"CAST(coalesce(sum(CAST({_q(m)} AS {vtype})), 0) AS {vtype})").alias(f"_m{i}") for i, m in enumerate(metrics)]
    per_date = base.groupBy(F.col(_q(region_col)).alias("_region"), F.col(_q(check_col)).alias("_check"),
                            F.expr(f"CAST({_q(date_col)} AS DATE)").alias("_date")).agg(*sums)
    if dates is None:
        ensure_checkpoint_dir(stat.sparkSession)
        per_date = per_date.checkpoint(eager=True)
        dates = [r[0] for r in per_date.select("_date").distinct().collect()]
    date_names = sorted({_date_text(d) for d in dates}, reverse=True)
    if not date_names:
        return stat.sparkSession.createDataFrame(
            [], f"{_q(region_col)} string, {_q(check_col)} string, {_q(type_col)} string")
    places = local_frame(stat.sparkSession, [(_dt.date.fromisoformat(d), i) for i, d in enumerate(date_names)],
                         "_date date, _place int")
    entry = F.struct("_place", *[f"_m{i}" for i in range(len(metrics))])
    keyed = (per_date.join(F.broadcast(places), "_date").groupBy("_region", "_check")        # a row per date
             .agg(F.array_sort(F.collect_list(entry)).alias("_entries"),
                  *[F.expr(f"CAST(sum(_m{i}) AS {vtype})").alias(f"_all{i}") for i in range(len(metrics))]))
    # the value of each date, after a zero for each date since the entry before
    gap = "x._place - IF(i = 0, 0, get(_entries, i - 1)._place + 1)"
    filled = [f"flatten(transform(_entries, (x, i) -> concat(array_repeat(CAST(0 AS {vtype}), {gap}), array(x._m{n}))))"
              for n in range(len(metrics))]
    rows = keyed.selectExpr("_region", "_check", f"stack({len(metrics)}, " + ", ".join(
        f"{_lit(m)}, _all{i}, {a}" for i, (m, a) in enumerate(zip(metrics, filled, strict=True)))
        + ") AS (_type, _all, _values)").where("_all <> 0")
    out = rows.select(F.col("_region").alias(region_col), F.col("_check").alias(check_col), F.col("_type").alias(type_col),
                      *[F.expr(f"coalesce(get(_values, {i}), CAST(0 AS {vtype}))").alias(d) for i, d in enumerate(date_names)])
    if sort:
        out = (out.withColumn(ORDINAL_COL, list_ordinal(type_col, metric_order))
               .orderBy(region_col, check_col, ORDINAL_COL).drop(ORDINAL_COL))
    if ordinal_col:
        out = out.withColumn(ordinal_col, list_ordinal(type_col, metric_order))
    return out


def extract_order(check_col: str = "chName", region_col: str = "macroRegion",
                  date_col: str = "eventDate", region_order: Sequence[str] = REGION_ORDER):
    """Sort keys of the daily extract: check ascending, region by its rank in the fixed list
    (unknown regions first), newest date first; the region code breaks remaining ties.
    NULL checks and dates sort last."""
    return [F.col(check_col).asc_nulls_last(),
            list_rank(region_col, region_order).asc_nulls_last(),
            F.col(date_col).desc_nulls_last(),
            F.col(region_col).asc_nulls_last()]


def ordered_extract(stat: DataFrame, *, check_col: str = "chName", region_col: str = "macroRegion",
                    date_col: str = "eventDate", region_order: Sequence[str] = REGION_ORDER,
                    pos_col: str | None = "pos") -> DataFrame:
    """The whole statistics table in report order (W5). With ``pos_col`` a 1-based position is
    added, computed without a single-task window (see ``position.with_position``)."""
    order = extract_order(check_col, region_col, date_col, region_order)
    if pos_col is None:
        return stat.orderBy(*order)
    return with_position(stat, order, pos_col)
