"""Token counts with a digest cache.

The cache is a Parquet table (content digest, tokenizer version, number of tokens). A count joins
the digests of the normalised texts to it, encodes the distinct misses only, appends them, and
joins again. The normal form only does what cannot change a count: where a tokenizer drops white space,
runs of it become one space and none stays at the ends; for other tokenizers it is the text itself.
The tokenizer's version is the digest of its file, so another file never meets old counts.

Each batch of encoded misses is added by one Parquet append, which commits whole or not at all; two writers
that add the same text add equal rows, and readers take one.

Defined results: NULL counts as the empty text, with 0 bytes and 0 tokens; a row per input row, also for
repeated and NULL doc_ids; other columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import tokens

CACHE_SCHEMA = "digest string, tokenizer string, n_tokens long"
#: up to this many misses (a key and a digest, about 150 bytes each) may be broadcast to the scan of texts
BROADCAST_ROWS = 500_000


def open_cache(spark, path: str | None = None) -> str:
    """Path of a cache table; a new, empty one in the shared folder unless ``path`` names one."""
    path = path or f"{C.shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return path


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, *, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    blob = tokens.read_file(tokenizer)
    name = tokens.version(blob)
    cache = open_cache(spark, cache)
    by_word = tokens.Encoder(blob).by_word

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    normal = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")) if by_word else F.col("text")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.withColumn("row_key", F.coalesce("doc_id", F.xxhash64("text")))
    digest = F.sha2(normal, 256)
    table = C.written(texts.select("doc_id", "row_key", F.octet_length("text").cast("long").alias("n_bytes"),
                                   digest.alias("digest")), "digests")

    def stored():
        known = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == name)
        return known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    # one row for each distinct miss: the smallest key that holds it
    misses = (table.groupBy("digest").agg(F.min("row_key").alias("row_key"))
              .join(stored(), "digest", "left_anti"))
    misses = C.written(misses, "misses")
    small = misses.count() <= BROADCAST_ROWS
    wanted = misses.groupBy("row_key").agg(F.collect_set("digest").alias("wanted"))
    found = texts.join(F.broadcast(wanted) if small else wanted, "row_key")
    found = found.withColumn("digest", digest).where(F.array_contains("wanted", F.col("digest")))

    def run(batches):
        enc = tokens.encoder(blob, name)
        for batch in batches:
            for lo, hi, _, counts in enc.encode(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([name] * (hi - lo)), pa.array(counts)],
                    ["digest", "tokenizer", "n_tokens"])

    found.select("digest", "text").mapInArrow(C.lean(run, name), CACHE_SCHEMA).write.mode("append").parquet(cache)
    return table.join(stored(), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
