"""The first n rows of every group for groups of any number and size.

``first_n`` finds, for each group with more than ``n`` rows, the value of the first order column at which the limit
falls, and keeps rows by comparing with it; no window orders a group.

* The rows of every group are counted (partial counts). Groups within the limit are kept whole. A group above it
  holds more than ``n`` rows, so there are at most rows / n of those.
* For the others a histogram of the order key is refined: a round counts the rows of each group's open range in SLOTS
  slots, takes the slot in which the limit falls, and goes on with the values that occur in it. A slot of one
  value, or one that ends exactly at the limit, ends the search. A round is one partial aggregation of at most SLOTS rows for
  each task and group, whatever the group holds; a day in microseconds takes at most four rounds.
* Rows below their group's cut pass by comparison, those at the cut are ranked by all order columns, salted, as many of
  them may be equal in the first.

The table of cuts is broadcast while its counted rows are at most BROADCAST_ROWS; beyond that rows and cuts meet by a
shuffle on (group, salt), with each cut copied once per salt, so a group that holds a third of the rows is read by
``fanout`` tasks.

Defined results: rows with a NULL first order column come first, as in an ascending order; NULL is a group value like others;
an empty table gives an empty one; of rows equal in all order columns any may be kept, the number is exact; ``n`` below 1 keeps
nothing; columns go by position inside, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.datetime import epoch_seconds_ntz_sql
from ..session import ensure_checkpoint_dir

SLOTS = 1024
BROADCAST_ROWS = 100_000
#: key of a NULL, below every time, date and whole number that is read
NULL_KEY = -(1 << 63)


def order_key(df: DataFrame, col: str) -> Column:
    """A long that orders as ``col`` does: microseconds of a time, days of a date, a whole number as it is."""
    kind, c = df.schema[col].dataType, F.col(f"`{col}`")
    if isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):                   # exact, whatever the session time zone
        c = F.expr(f"{epoch_seconds_ntz_sql(f'`{col}`')} * 1000000 + CAST(extract(SECOND FROM `{col}`) * 1000000 AS BIGINT) % 1000000")
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{col}: the first order column is a time, a date or a whole number, not {kind.simpleString()}")
    return F.coalesce(c.cast("bigint"), F.lit(NULL_KEY))


def _same(groups: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}")) for g in groups])


def _with_cuts(rows: DataFrame, cuts: DataFrame, n_cuts: int, groups: Sequence[str], fanout: int, how: str) -> DataFrame:
    """``rows`` (with ``_salt``) joined to the columns ``_lo``, ``_hi`` and ``_left`` of their group's cut."""
    wanted = ["_lo", "_hi", "_left"]
    if n_cuts <= BROADCAST_ROWS:
        on = _same(groups, "r", "c")
        right = F.broadcast(cuts.alias("c"))
    else:
        copies = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(int(fanout) - 1))))
        on = _same(groups, "r", "c") & (F.col("r._salt") == F.col("c._salt"))
        right = copies.alias("c")
    return rows.alias("r").join(right, on, how).select("r.*", *[f"c.{w}" for w in wanted])


def cut_values(rows: DataFrame, groups: Sequence[str], n: int, fanout: int) -> tuple[DataFrame, int]:
    """(table of ``groups``, ``_lo``, ``_hi``, ``_left``; its rows): for each group of more than ``n`` rows the key ``_lo`` (=
    ``_hi``) at which the limit falls and how many rows with that key are still within it."""
    counted = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))
    opened = (counted.where(F.col("_n") > n).select(*groups, "_lo", "_hi", F.lit(n).cast("bigint").alias("_left"))
              .checkpoint(eager=True))
    done: list[DataFrame] = []
    total = left = opened.count()
    while left:
        ended = opened.where("_lo = _hi")
        done.append(ended)
        opened = opened.where("_lo < _hi")
        left = opened.count()
        if not left:
            break
        # of halves, as the range of two longs may not fit a long; a range within one half has two values
        half = "(shiftright({}, 1) - shiftright(_lo, 1))".format
        slot = f"IF({half('_hi')} = 0, _key & 1, {half('_key')} div ({half('_hi')} div {SLOTS} + 1))"
        ranged = _with_cuts(rows, opened, left, groups, fanout, "inner").where("_key BETWEEN _lo AND _hi")
        slots = (ranged.select(*groups, "_key", "_left", F.expr(slot).alias("_slot")).groupBy(*groups, "_slot")
                 .agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi"),
                      F.first("_left").alias("_left")))
        upto = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_slot"))       # at most SLOTS rows a group
        found = (slots.withColumn("_upto", upto).where("_upto >= _left AND _upto - _n < _left")
                 .withColumn("_all", F.expr("_upto = _left")))
        # a slot that ends at the limit: all rows of its greatest value are within it
        opened = found.select(*groups, F.when(F.col("_all"), F.col("_hi")).otherwise(F.col("_lo")).alias("_lo"), "_hi",
                              F.when(F.col("_all"), F.lit((1 << 63) - 1)).otherwise(F.expr("_left - (_upto - _n)")).alias("_left")
                              ).checkpoint(eager=True)
    return (reduce(DataFrame.unionByName, done) if done else opened), total


def first_n(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], n: int, *, fanout: int = 32) -> DataFrame:
    """The first ``n`` rows of every group by ``order_cols`` (``limit n by group``), with the columns of ``df``. The first
    order column is a time, a date or a whole number."""
    n = int(n)
    if n < 1:
        return df.limit(0)
    ensure_checkpoint_dir(df.sparkSession)
    names = df.columns
    own = df.select("*", order_key(df, order_cols[0])).toDF(*[f"c{i}" for i in range(len(names))], "_key")
    groups = [f"c{names.index(g)}" for g in group_cols]
    order = [f"c{names.index(o)}" for o in order_cols]
    rows = own.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(int(fanout))).cast("int"))
    cuts, n_cuts = cut_values(rows.select(*groups, "_key", "_salt"), groups, n, fanout)
    if not n_cuts:
        return df
    joined = _with_cuts(rows, cuts, n_cuts, groups, fanout, "left")
    below = joined.where(f"_lo IS NULL OR _key < _lo OR (_key = _lo AND _left = {(1 << 63) - 1})")
    at_cut = joined.where(f"_key = _lo AND _left < {(1 << 63) - 1}")
    for group in ([*groups, "_salt"], groups):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        at_cut = at_cut.withColumn("_r", rank).where("_r <= _left").drop("_r")
    return below.unionByName(at_cut).select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
