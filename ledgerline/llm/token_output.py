"""Token ids on disk: frequency-ranked, byte-aligned, with separate control bytes.

All ids of the corpus are counted; the commonest id gets rank 0. A rank is written in as many bytes (1 to
4) as it needs, least significant first; the lengths of four ranks, two bits each, share one control byte, and each document starts a new one.
Decoding looks each control byte up in a table of lengths and gathers the bytes with numpy, no loop over
ids.

The files: folders ``part=N``, whose numbers ascend with doc_id, hold Parquet rows that are blocks of
whole documents in ascending doc_id order: ``block, first_token, doc_ids, counts, control, data``.
``first_token`` counts the ids of the part before the block. Folder ``ranks`` lists the id of each
rank. Spark's writer commits the files, so a lost executor's half-written ones never show.

The ids of each text are encoded once and kept as a table, from which the ranks are counted and
the files are written. The bounds of the parts are approximate quantiles of doc_id alone; any bounds give
right files.

Defined results: NULL and empty texts are the end id alone; a row per input row; rows that share a doc_id
come in the order of their bytes; NULL doc_ids come first; other columns aren't read; an empty table
gives empty files and an empty result.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import tokens

#: documents of one part, on average, and the largest number of parts
PART_DOCS = 4_096
PARTS = 20_000
#: a block is closed when its data reaches this many bytes
BLOCK_BYTES = 1 << 20

_LENGTHS = np.stack([(np.arange(256) >> (2 * k) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)
_COLUMN = np.arange(4, dtype=np.uint8)


def pack_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control bytes, data bytes, control bytes of each document, data bytes of each) of the ranks of
    consecutive documents. Each document starts a control byte of its own."""
    r = np.ascontiguousarray(ranks, dtype="<u4")
    n = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    controls = -(-counts // 4)
    ends = np.cumsum(counts)
    pad = 4 * (np.cumsum(controls) - controls) - (ends - counts)
    code = np.zeros(4 * int(controls.sum()), dtype=np.uint8)
    code[np.arange(len(r)) + np.repeat(pad, counts)] = n - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    data = r.view(np.uint8).reshape(-1, 4)[_COLUMN < n[:, None]]
    sums = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
    return control.astype(np.uint8), data, controls, sums[ends] - sums[ends - counts]


def unpack_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks again, by table lookup of the control bytes."""
    n = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()
    controls = -(-counts // 4)
    pad = 4 * (np.cumsum(controls) - controls) - (np.cumsum(counts) - counts)
    n = n[np.arange(int(counts.sum())) + np.repeat(pad, counts)]
    out = np.zeros((len(n), 4), dtype=np.uint8)
    out[_COLUMN < n[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return out.view("<u4").ravel()


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column of consecutive values of these sizes in bytes."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def _encoded(docs: DataFrame, blob: bytes, end_id: int, width: str) -> DataFrame:
    """(doc_id, n_tokens, ids) with the end id."""
    name = tokens.version(blob)

    def run(batches):
        enc = tokens.encoder(blob, name)
        for batch in batches:
            for lo, hi, ids, counts in enc.encode(batch.column(1)):
                ends = np.cumsum(counts)
                full = np.insert(ids, ends, end_id).astype(width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts + 1),
                     _binary(full, (counts + 1) * full.itemsize)], ["doc_id", "n_tokens", "ids"])

    return docs.mapInArrow(C.lean(run, name), "doc_id long, n_tokens long, ids binary")


def _ranked(encoded: DataFrame, width: str) -> list[int]:
    """All ids by falling frequency, ties by id: at most the tokenizer's vocabulary."""
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                ids = np.frombuffer(b"".join(batch.column(0).slice(lo, 1000).to_pylist()), dtype=width)
                c = np.bincount(ids)
                if len(c) > len(total):
                    c, total = total, c.astype(np.int64)
                total[:len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counts = encoded.select("ids").mapInArrow(C.lean(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counts.collect()
    return [r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))]


def _parts(docs: DataFrame) -> list[int]:
    """Upper bounds (exclusive) of all parts but the last."""
    n = docs.count()
    parts = min(PARTS, -(-n // PART_DOCS))
    if parts < 2:
        return []
    at = [k / parts for k in range(1, parts)]
    return sorted({int(x) for x in docs.approxQuantile("doc_id", at, 0.1 / parts)})


_BLOCK = "part int, block int, first_token long, doc_ids array<long>, counts array<int>, control binary, data binary"


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2, id_col: str = "doc_id",
          text_col: str = "text") -> str:
    """Encode ``docs`` and write the files under ``path``."""
    spark = docs.sparkSession
    blob = tokens.read_file(tokenizer)
    width = "<u2" if max(tokens.Encoder(blob).tk.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bounds = np.array(_parts(texts.select("doc_id")), dtype=np.int64)
    encoded = C.written(_encoded(texts, blob, end_id, width), "token-ids")
    by_rank = _ranked(encoded, width)
    rank_of = np.zeros(max(by_rank, default=0) + 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def recode(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                counts = part.column(1).to_numpy()
                ids = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=width)
                control, data, controls, sizes = pack_ranks(rank_of[ids], counts)
                doc = part.column(0)
                number = np.searchsorted(bounds, doc.fill_null(-1 << 63).to_numpy(), side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number.astype(np.int32)), doc, part.column(1), _binary(control, controls),
                     _binary(data, sizes)], ["part", "doc_id", "n_tokens", "control", "data"])

    def blocks(batches):
        open_, size, part, block, before = [], 0, None, 0, 0

        def closed():
            ids, counts, control, data = zip(*open_, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], type=pa.int32()), pa.array([block], type=pa.int32()), pa.array([before]),
                 pa.array([list(ids)], type=pa.list_(pa.int64())),
                 pa.array([list(counts)], type=pa.list_(pa.int32())), pa.array([b"".join(control)], type=pa.binary()),
                 pa.array([b"".join(data)], type=pa.binary())],
                ["part", "block", "first_token", "doc_ids", "counts", "control", "data"])

        for batch in batches:
            for p, doc, n, c, d in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if open_ and (p != part or size > BLOCK_BYTES):
                    yield closed()
                    block, before = block + 1, before + sum(x[1] for x in open_)
                    open_, size = [], 0
                if p != part:
                    part, block, before = p, 0, 0
                open_.append((doc, n, c, d))
                size += len(d)
        if open_:
            yield closed()

    rows = encoded.mapInArrow(C.lean(recode), "part int, doc_id long, n_tokens long, control binary, data binary")
    (rows.repartition("part").sortWithinPartitions("part", "doc_id", "n_tokens", "data")
     .mapInArrow(C.lean(blocks), _BLOCK).write.partitionBy("part").option("compression", "uncompressed").parquet(f"{path}/ids"))
    spark.createDataFrame([(r, i) for r, i in enumerate(by_rank)], "rank long, id long").coalesce(1).write.parquet(
        f"{path}/ranks")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32. ``start`` counts the ids of all
    documents before it."""
    by_rank = np.array([r["id"] for r in spark.read.schema("rank long, id long").parquet(f"{path}/ranks")
                        .orderBy("rank").collect()], dtype="<u4")       # the vocabulary at most
    stored = spark.read.schema(_BLOCK).parquet(f"{path}/ids")
    total = stored.groupBy("part").agg(F.sum(F.expr("aggregate(counts, 0L, (a, n) -> a + n)")).alias("n"))
    base = total.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS base")       # a row per part

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                counts = np.array(r["counts"], dtype=np.int64)
                ids = by_rank[unpack_ranks(r["control"], r["data"], counts)]
                ends = np.cumsum(counts)
                view = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], type=pa.int64()), pa.array(r["base"] + r["first_token"] + ends - counts),
                     pa.array(counts), pa.array(crc, type=pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (stored.join(F.broadcast(base), "part")                       # at most PARTS rows
            .select("first_token", "doc_ids", "counts", "control", "data", "base")
            .mapInArrow(C.lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, tokenizer: str, *, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the files and read them back."""
    path = path or f"{C.shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    return read(docs.sparkSession, write(docs, path, tokenizer, end_id=end_id))
