"""Global row position of a sorted DataFrame without moving all rows into one task.

A ``row_number()`` over a window with no partition pulls every row into a single task. Instead:
sort with Spark's range-partitioned ``orderBy`` (a distributed sort), tag each row with
``monotonically_increasing_id`` (partition index in the upper bits, row index in the lower 33),
write that once to the checkpoint folder so the ids cannot change under recomputation, count rows
per partition (one small row per partition goes to the driver), and add each partition's offset
through a broadcast join of that per-partition table, whose size is bounded by the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import local_frame

_MID = "_mono_id"
_PART = "_part"
_LOW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order_cols: Sequence[str | Column], pos_col: str = "pos") -> DataFrame:
    """``df`` sorted by ``order_cols`` with a 1-based ``pos_col``. ``order_cols`` should be a total
    order; ties get consecutive positions in an arbitrary but fixed (checkpointed) order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tagged = (df.orderBy(*order_cols)
              .withColumn(_MID, F.monotonically_increasing_id())
              .checkpoint(eager=True))
    with_part = tagged.withColumn(_PART, F.shiftright(F.col(_MID), 33))
    counts = sorted((r[0], r[1]) for r in with_part.groupBy(_PART).count().collect())
    offsets, running = [], 0
    for part, n in counts:
        offsets.append((int(part), running))
        running += int(n)
    off_df = local_frame(spark, offsets or [(0, 0)], f"{_PART} bigint, _offset bigint")
    out = (with_part.join(F.broadcast(off_df), _PART, "inner")
           .withColumn(pos_col, F.col("_offset") + F.col(_MID).bitwiseAND(F.lit(_LOW_BITS)) + 1)
           .drop(_PART, "_offset", _MID))
    # the checkpointed rows are range-partitioned in sort order and the broadcast join keeps each
    # partition's order, so sorting inside partitions restores full order without a shuffle
    return out.sortWithinPartitions(pos_col)
