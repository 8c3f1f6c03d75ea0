"""Membership filter of a table by another's keys, as a bitmap of hashed keys (P5).

``bitmap_candidates`` is ``key IN (SELECT key ...)`` for a counterpart that is much larger than its candidates: every key of the
source sets one of ``2 ** bits`` positions, the bitmap is broadcast, and counterpart rows whose position is not set are
dropped in the scan's stage, before any shuffle. An exact semi join on what is left removes the false hits.

The broadcast has ``2 ** bits / 8`` bytes at most, whatever the source holds; ``MAX_BITS`` is 64 MB. With more keys than
positions the filter lets more rows pass and the result stays exact. The bitmap is built by partial aggregation (a
bitmap of 4 KB for each 32,768 positions), so a key that holds a third of the source is one bit in each task.

Defined results: NULL keys are candidates of nothing and match nothing; repeated rows stay; an empty source
leaves nothing; columns of the counterpart are handed on as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, MAX_BITS = 27, 29
#: a bitmap of Spark's aggregate covers 32,768 positions; it is cut into pieces, as a lookup copies its piece
PIECE_BYTES = 256
_PIECES = 4096 // PIECE_BYTES


def position(key: Column, bits: int) -> Column:
    """The key's position, from 1 to ``2 ** bits``."""
    return F.pmod(F.xxhash64(key), F.lit(1 << bits)) + 1


def key_bitmap(source: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(piece, bitmap): the set positions of all keys, PIECE_BYTES a row; pieces without one are left out."""
    if not 15 <= bits <= MAX_BITS:
        raise ValueError(f"bits is from 15 to {MAX_BITS}")
    at = source.where(F.col(f"`{key}`").isNotNull()).select(position(F.col(f"`{key}`"), bits).alias("at"))
    maps = (at.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")))
    pieces = maps.selectExpr("bucket", "bitmap", f"explode(sequence(0, {_PIECES - 1})) AS i").selectExpr(
        f"(bucket - 1) * {_PIECES} + i AS piece", f"substring(bitmap, i * {PIECE_BYTES} + 1, {PIECE_BYTES}) AS bitmap")
    return pieces.where(F.bitmap_count("bitmap") > 0)


def maybe_in(df: DataFrame, bitmap: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows whose key's position is set: all that are in the bitmap's source, and false hits."""
    at = f"(pmod(xxhash64(`{key}`), {1 << bits}L))"
    bit = f"CAST(conv(hex(substring(_bitmap, {at} % {8 * PIECE_BYTES} div 8 + 1, 1)), 16, 10) AS INT)"
    on = F.expr(f"`{key}` IS NOT NULL AND {at} div {8 * PIECE_BYTES} = _piece AND "
                f"shiftright({bit}, CAST({at} % 8 AS INT)) & 1 = 1")
    return df.join(F.broadcast(bitmap.toDF("_piece", "_bitmap")), on, "left_semi")


def bitmap_candidates(counterpart: DataFrame, source: DataFrame, key: str = "IMSI", bits: int = BITS) -> DataFrame:
    """Counterpart rows whose ``key`` occurs in the source."""
    near = maybe_in(counterpart, key_bitmap(source, key, bits), key, bits)
    return near.join(source.select(key).distinct(), key, "left_semi").select(*[f"`{c}`" for c in counterpart.columns])
