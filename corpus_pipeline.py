"""A corpus from raw documents to packed training sequences.

``STAGES`` names the stages in order; each takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; what a stage returns is written as Parquet and read again as the next one's documents.

1. ``toxicity``: documents scoring 0.7 or more go.
2. ``near_duplicates``: of documents linked at Jaccard 0.8 on five-word shingles, directly or through others, the
   one of smallest id stays.
3. ``substring_dedup``: a passage of 50 words or more that appeared before (in a smaller id, or earlier in
   the text) is cut out; what is left of its text stays as it was, and ``n_chars`` follows.
4. ``decontamination``: documents that overlap with a benchmark item go.
5. ``packing``: sequences of at most 2048 tokens.

Rows with NULL ids or texts pass the filtering stages and are packed like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common, decontamination, minhash, packing, substring_dedup, toxicity
from ledgerline.llm.queries import table, tokenizer

REPEAT_WORDS = 50

#: SQL cannot express the model of the first stage or the last one's packing
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepared(spark)
    return minhash.without_near_duplicates(docs, shingle=5, num=80, den=100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepared(spark)
    cut = substring_dedup.without_repeats(docs, window=REPEAT_WORDS)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))
    return cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepared(spark)
    return packing.best_fit(docs, tokenizer("word_bpe_49k.json"), size=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
