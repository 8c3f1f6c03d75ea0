"""Whole-numbered vectors for the exact searches: reading them, exact inner products, blocks that queries meet."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: components beyond this count as this, so that scaling stays finite
LARGEST = 1e300
#: rows of queries that are multiplied with a block at a time
ASKED = 256


def usable(vectors: DataFrame, id_col: str, vector_col: str, *more) -> DataFrame:
    """(vec_id, v, ...) of the rows with an id and a vector without NULL or non-finite components."""
    v = F.col(f"`{vector_col}`")
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"), *more)
            .where("vec_id IS NOT NULL AND v IS NOT NULL")
            .where("forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity'))"))       # NaN is larger still


def whole(column: pa.Array, size: int, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, as doubles; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), size))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[np.arange(size) < lengths[:, None]] = np.floor(flat.clip(-LARGEST, LARGEST) * scale)
    return out


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of ``a`` with those of ``b``, exactly, as int64. Those beyond the range of
    long are its ends."""
    with np.errstate(over="ignore"):
        largest = norms(a).max(initial=0) * norms(b).max(initial=0)
    if largest < 2 ** 53:                                # then no partial sum in doubles is rounded
        return (a @ b.T).astype(np.int64)
    x, y = ([[int(v) for v in row] for row in m.tolist()] for m in (a, b))
    ends = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(sum(p * q for p, q in zip(r, s, strict=True)), ends[0]), ends[1]) for s in y] for r in x],
                    dtype=np.int64).reshape(len(a), len(b))


def met(batches, keys: list[str], hold: Callable, answer: Callable) -> Iterator[pa.RecordBatch]:
    """A stream sorted by ``keys`` and ``asks``: the rows of a group with asks = 0 are a block of bounded size,
    which ``hold`` turns into what ``answer(held, rows)`` looks the group's other rows up in. Those are
    answered as they come and not kept."""
    group, block, held = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in [*keys, "asks"]]
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        at = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(at[:-1], at[1:], strict=True):
            part, name = batch.slice(a, b - a), tuple(c[a] for c in columns[:-1])
            if name != group:
                group, block, held = name, [], None
            if columns[-1][a] == 0:
                block.append(part)
                continue
            if not block:
                continue                                 # nobody to meet
            if held is None:
                held = hold(pa.Table.from_batches(block))
            for lo in range(0, part.num_rows, ASKED):
                yield from answer(held, part.slice(lo, ASKED))
