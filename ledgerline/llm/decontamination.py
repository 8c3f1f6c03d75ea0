"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions alone.

Texts become tokens: runs of ASCII letters, digits and non-ASCII characters, in lower case. Two masks
of SPAN positions look at four tokens each and ignore the rest. A window of WINDOW tokens with at most three of
them replaced always keeps the four tokens of one mask at one place (checked over all 286 choices of three
places in the tests), so joining the hashes of all masked places of test and training texts finds every such
overlap. Items shorter than a window need the same share of their own length; those of 7 and 9 tokens also take
MORE, a mask of five positions, and texts are only hashed by it while the benchmark has such items. Each hit is verified token by token: some window of WINDOW tokens around it, on the hit's
alignment, must agree in NEED tokens or more.

The side with the test hashes is broadcast while it has at most BROADCAST_ROWS rows, and the hits are
verified in the row where they occur; beyond that the hashes are joined by shuffle and the hits meet
their texts again.

Defined results: NULL, empty and very short texts (fewer than SPAN tokens) overlap with nothing, and test
items as short or NULL are not searched for; repeated rows get equal results; a NULL doc_id is a
document like others; an empty benchmark contaminates nothing; columns other than id and text are kept
and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import written

SPAN = 7
MASKS = ((0, 1, 2, 6), (0, 3, 4, 6))
WINDOW, NEED = 13, 10
#: the mask that MASKS lack for items of these sizes
MORE, MORE_SIZES = (0, 2, 3, 4), (7, 9)
BROADCAST_ROWS = 1_000_000

#: what separates tokens: all ASCII but letters and digits
SEPARATORS = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def token_hashes(text: Column) -> Column:
    """array<long>, one hash a token."""
    words = F.array_remove(F.split(F.lower(text), SEPARATORS), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def masks(size: int) -> tuple:
    """The masks that an item of ``size`` tokens is looked for by."""
    return (*MASKS, MORE) if size in MORE_SIZES else MASKS


def seeds(words: str, more: str = "false") -> Column:
    """array<struct<place, seed>>: the hashes of each mask at every place; those of MORE where ``more`` holds."""
    masked = []
    for m, mask in enumerate((*MASKS, MORE)):
        at = (f"transform(sequence(0, size({words}) - {mask[-1] + 1}), i -> struct(cast(i as int) as place, xxhash64({m}, "
              + ", ".join(f"get({words}, i + {p})" for p in mask) + ") as seed))")
        masked.append(at if mask != MORE else f"if({more}, {at}, array())")
    if more == "false":
        masked.pop()
    return F.expr(f"if(size({words}) >= {SPAN}, concat({', '.join(masked)}), array())")


def _exploded(df: DataFrame, *keep: str, more: str = "false") -> DataFrame:
    """A row per masked place: ``place`` counts within its mask."""
    return df.select(*keep, F.inline(seeds("words", more)))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id): verified overlaps, one row for each text and test item."""
    items = (benchmark.select(F.col(item_col).alias("item_id"), token_hashes(F.col(item_text_col)).alias("words"))
             .where(F.size("words") >= SPAN))
    short = f"size(words) IN {MORE_SIZES}"
    more = "false" if items.where(short).isEmpty() else "true"
    wanted = (_exploded(items, "item_id", "words", more="false" if more == "false" else short)
              .select("seed", "item_id", F.col("place").alias("item_place"), F.col("words").alias("item_words")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        token_hashes(F.col(text_col)).alias("words"))
    if wanted.count() <= BROADCAST_ROWS:
        hits = _exploded(texts, "doc_id", "text_hash", "words", more=more).join(F.broadcast(wanted), "seed")
    else:
        found = (_exploded(texts, "doc_id", "text_hash", more=more).join(wanted.drop("item_words"), "seed")
                 .groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("place", "item_id", "item_place")).alias("at")))
        again = found.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
        hits = (texts.dropDuplicates(["doc_id", "text_hash"])
                .join(again, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
                .select("doc_id", "text_hash", "words", F.inline("at"))
                .join(items.withColumnRenamed("words", "item_words"), "item_id"))
    window = f"least({WINDOW}, size(item_words))"
    # windows of the item that hold the masked places, and how many of their tokens agree
    verified = F.expr(f"""
        exists(sequence(greatest(0, least(item_place + {SPAN}, size(item_words)) - {window}), least(item_place, size(item_words) - {window})),
               s -> size(filter(sequence(s, s + {window} - 1),
                                x -> get(words, place - item_place + x) = item_words[x])) * {WINDOW}
                    >= {NEED} * {window})""")
    return hits.where(verified).select("doc_id", "text_hash", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: the id, contaminated, n_items, and the overlapping items in ascending order."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = (overlaps(slim, benchmark, "id", "text")
             .groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))            # at most the benchmark's items
    named = slim.select("id", F.xxhash64("text").alias("own_hash"))                   # no text is shuffled
    out = named.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("own_hash") == F.col("found_hash")), "left")
    return out.select(F.col("id").alias(id_col), F.col("items").isNotNull().alias("contaminated"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items", F.expr("cast(array() as array<bigint>)")).alias("items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The documents that overlap with no test item, unchanged. Inside, columns go by position, so no name can clash."""
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    found = written(overlaps(own.select(doc_id, text), benchmark, doc_id, text).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).distinct(), "leaks")
    few = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    same = F.col(doc_id).eqNullSafe(F.col("found_id")) & (F.xxhash64(text) == F.col("found_hash"))
    return own.join(few, same, "left_anti").toDF(*docs.columns)
