"""MinHash near-duplicates by a multi-index Hamming join.

1. One pass over the texts: the set of word shingles (64-bit hashes), its size, a 128-bit name of the
   set, and a signature of CHUNKS * WIDTH MinHash values of 16 bits each. Rows with equal sets
   collapse to their smallest doc_id (an ordinary aggregation, combined before the shuffle).
2. The distance of two signatures is the number of values in which they differ. The signature is
   split into CHUNKS chunks of WIDTH values; in each chunk one wrong value is allowed and
   enumerated (WIDTH masked keys a chunk). By the pigeonhole principle every pair within distance
   ``2 * CHUNKS - 1`` shares a key; a pair beyond it still does unless each chunk has two wrong values.
   At Jaccard 0.8 a chunk of seven has two or more with probability 0.423, so all fourteen do with
   probability 6e-6, at 0.85 with 1e-7.
3. Inside a key no pairs are spelt out: every set is compared with the smallest set under the key
   (copies are combined in the mapper first), the nearest such partner by signature is confirmed on
   full sets, and the confirmed links give components.
4. Keys whose members still lie in several components go through an exact second look: in blocks of
   bounded size, members of different components whose signatures are within LOOK are gathered to
   families, and all pairs between components of a family are confirmed on full sets, again in
   blocks. So no link is lost to the choice of partners; there is no cap on a key's members.

Links are confirmed with whole numbers: ``den * intersection >= num * union``.

Defined results: a NULL, empty or wordless text has no shingles, is linked with nothing and is its
own component; texts with fewer words than a shingle have their whole word sequence as one shingle;
a NULL doc_id takes no part (component NULL, kept); rows with one doc_id count as one document, so
what they are linked with is joined. The result has a row per input row; other columns of the input are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C

CHUNKS, WIDTH = 14, 7
VALUES = CHUNKS * WIDTH
#: signatures further apart than this many values are not looked at again in step 4: at Jaccard 0.8
#: a distance has mean 19.6 and deviation 4, so this is 6 deviations away
LOOK = 44
#: members of one key, or of one family, that meet in one task at a time
BLOCK = 1024
#: node lists up to this many rows (8 bytes each) may be broadcast; longer ones are shuffled
BROADCAST_ROWS = 1_000_000

_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_SALT = C.mix(np.arange(1, VALUES * 2 + 1, dtype=np.uint64))


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z in lower case)."""
    for lo, hi, data, offsets in C.pieces(column):
        starts, ends, first = C.word_spans(data, offsets)
        words = C.word_hashes(C.lowered(data), starts, ends)
        n = max(0, len(words) - shingle + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for k in range(shingle):
            grams = C.mix(grams * C._U(0x9E3779B97F4A7C15) + words[k:k + n] + C._U(k + 1))
        for i in range(hi - lo):
            a, b = first[i], first[i + 1]
            if b - a >= shingle:
                x = np.sort(grams[a:b - shingle + 1])
                yield x[np.concatenate(([True], x[1:] != x[:-1]))]
            elif b > a:
                h = np.zeros(1, dtype=np.uint64)
                for k in range(a, b):
                    h = C.mix(h * C._U(0x9E3779B97F4A7C15) + words[k:k + 1] + C._U(k - a + 1))
                yield C.mix(h + C._U(b - a))
            else:
                yield words[:0]


def signature(grams: np.ndarray) -> np.ndarray:
    """VALUES MinHash values, the low 16 bits of each."""
    x = (grams >> C._U(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(x), 4096):
        part = x[lo:lo + 4096]
        np.minimum(least, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=least)
    return least.astype(np.uint16)


def masked_keys(sigs: np.ndarray) -> np.ndarray:
    """(rows, VALUES) keys: key ``c * WIDTH + j`` hashes chunk c without its value j."""
    v = C.mix(sigs.astype(np.uint64) + _SALT[None, :VALUES]).reshape(len(sigs), CHUNKS, WIDTH)
    keys = v.sum(axis=2, dtype=np.uint64)[:, :, None] - v
    return C.mix(keys.reshape(len(sigs), VALUES) + _SALT[None, VALUES:])


def sig_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(-1, VALUES)


# ---------------------------------------------------------------- the steps

def _signed_documents(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            n, s1, s2, sigs = [], [], [], []
            for grams in shingle_sets(batch.column(1), shingle):
                n.append(len(grams))
                s1.append(int(C.mix(grams).sum(dtype=np.uint64)))
                s2.append(int(np.bitwise_xor.reduce(C.mix(grams ^ C._U(0x5851F42D4C957F2D)))))
                sigs.append(signature(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, type=pa.int64()),
                 pa.array(np.array(s1, dtype=np.uint64).view(np.int64)),
                 pa.array(np.array(s2, dtype=np.uint64).view(np.int64)),
                 pa.array(sigs, type=pa.binary())], ["doc_id", "n_shingles", "s1", "s2", "sig"])

    return docs.mapInArrow(C.lean(run), "doc_id long, n_shingles long, s1 long, s2 long, sig binary")


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, a, b): a set under a key; or, with b, a set and the smallest one that its batch has
    under one of its keys, which then stands for both."""
    def run(batches):
        for batch in C.gathered(batches, 4000):
            node = batch.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(node, kind="stable")
            keys = masked_keys(sig_matrix(batch.column(1).to_pylist()))[order].ravel()
            node = np.repeat(node[order], VALUES)
            by = np.argsort(keys, kind="stable")
            keys, node = keys[by], node[by]
            new = np.concatenate(([True], keys[1:] != keys[:-1]))
            least = node[np.flatnonzero(new)][np.cumsum(new) - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[new].view(np.int64)), pa.array(node[new]),
                 pa.nulls(int(new.sum()), pa.int64())], ["key", "a", "b"])
            pair = np.unique(np.stack([node[~new], least[~new]], axis=1), axis=0)
            pair = pair[pair[:, 0] != pair[:, 1]]
            if len(pair):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.mix(pair[:, 0].astype(np.uint64)).view(np.int64)),
                     pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["key", "a", "b"])

    return nodes.select("node", "sig").mapInArrow(C.lean(run), "key long, a long, b long")


def _distance(a, b):
    """Differing values of two signatures, a vectorised column function."""
    @F.pandas_udf("int")
    def differ(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series((sig_matrix(x) != sig_matrix(y)).sum(axis=1).astype("int32"))
    return differ(a, b)


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are links on full sets."""
    x = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    y = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    return (pairs.join(x, "a").join(y, "b")
            .withColumn("both", both)
            .where(F.col("both") * den >= (F.size("ga") + F.size("gb") - F.col("both")) * num)
            .select("a", "b"))


def _in_blocks(members: DataFrame, group: str) -> DataFrame:
    """Replicate the members of a group so that any two meet in a (group, left, right) block of at
    most about 2 * BLOCK members. A group of up to BLOCK members is one block."""
    sizes = members.groupBy(group).agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    return (members.join(sizes, group).withColumn("blocks", blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other"))
            .drop("size", "blocks", "other"))


def _first_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first of the VALUES masked keys that signature ``a`` shares with each row of ``b``."""
    differ = (b != a).reshape(len(b), CHUNKS, WIDTH)
    shared = differ.sum(axis=2) <= 1
    chunk = shared.argmax(axis=1)
    return chunk * WIDTH + differ[np.arange(len(b)), chunk].argmax(axis=1)


def _families(members: DataFrame) -> DataFrame:
    """(a, b): each member that is near one of another component under the same key, and the
    smallest member it is chained to by such nearness in its block. A pair counts under the first
    key that it shares."""
    def load(batch):
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("key", "left", "right", "slot", "node", "comp", "own")}
        return cols | {"sig": sig_matrix(batch.column("sig").to_pylist())}

    def run(batches):
        pairs: list[tuple[int, int]] = []
        for g in C.groups(batches, ["key", "left", "right"], load):
            pairs += chains(g)
            if len(pairs) > 100_000:
                yield rows(pairs)
                pairs = []
        yield rows(pairs)

    def rows(pairs):
        flat = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        flat = np.unique(flat, axis=0)
        return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])

    def chains(g) -> list[tuple[int, int]]:
        node, comp, sigs, slot = g["node"], g["comp"], g["sig"], g["slot"][0]
        ls, rs = np.flatnonzero(g["own"] == g["left"][0]), np.flatnonzero(g["own"] == g["right"][0])
        # one side of every pair lies outside the block's largest component
        names, which, count = np.unique(comp, return_inverse=True, return_counts=True)
        if len(names) < 2:
            return []
        minor = which != count.argmax()
        root = list(range(len(node)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for mine, others in ((ls, rs), (rs, ls)) if g["left"][0] != g["right"][0] else ((ls, rs),):
            for i in mine[minor[mine]]:
                js = others[comp[others] != comp[i]]
                js = js[(sigs[js] != sigs[i]).sum(axis=1) <= LOOK]
                if len(js):
                    js = js[_first_slot(sigs[i], sigs[js]) == slot]
                for j in js.tolist():
                    a, b = find(i), find(j)
                    if a != b:                               # the smaller node stays on top
                        if node[a] > node[b]:
                            a, b = b, a
                        root[b] = a
        tops = [find(i) for i in range(len(root))]
        return [(int(node[i]), int(node[t])) for i, t in enumerate(tops) if i != t]

    by = ["key", "left", "right"]
    return (members.repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(C.lean(run), "a long, b long"))


def _family_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """Confirmed links between components, a spanning set of them for each block. The sizes of all
    intersections of a block come from matrix products over the shingles that occur twice or more."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node, comp, own = (pdf[c].to_numpy() for c in ("node", "comp", "own"))
        size = pdf["grams"].map(len).to_numpy()
        row = np.repeat(np.arange(len(node)), size)
        flat = np.concatenate([np.asarray(g, dtype=np.int64) for g in pdf["grams"]])
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[code] > 1
        row, code = row[shared], code[shared]
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        ls, rs = np.flatnonzero(own == pdf["left"].iat[0]), np.flatnonzero(own == pdf["right"].iat[0])
        both = np.zeros((len(ls), len(rs)), dtype=np.float64)
        for lo in range(0, int(code.max()) + 1 if len(code) else 0, 2048):
            a, b = np.searchsorted(code, [lo, lo + 2048])
            part = np.zeros((len(node), 2048), dtype=np.float32)
            part[row[a:b], code[a:b] - lo] = 1
            both += part[ls] @ part[rs].T
        union = size[ls][:, None] + size[rs][None, :] - both
        i, j = np.nonzero((both * den >= union * num) & (comp[ls][:, None] != comp[rs][None, :]))
        links = pd.DataFrame({"a": node[ls[i]], "b": node[rs[j]], "x": comp[ls[i]], "y": comp[rs[j]]})
        return links.drop_duplicates(["x", "y"])[["a", "b"]]      # one link joins two components

    return members.groupBy("family", "left", "right").applyInPandas(run, "a long, b long")


def _sized(df: DataFrame) -> DataFrame:
    """``df`` for the small side of a join: broadcast only where its row count is within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest linked doc_id), kept (the component's
    own smallest). Links: ``den * intersection >= num * union`` on shingle sets of ``shingle`` words."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    signed = C.written(_signed_documents(texts, shingle), "signatures")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets have equal signatures, so any row's will do
    reps = C.written(named.groupBy("s1", "s2").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("rows"), F.first("sig").alias("sig"),
        F.first("n_shingles").alias("n_shingles")), "sets")
    nodes = reps.select("node", "sig", "n_shingles")

    # step 3: each set and the smallest set under each of its keys
    w = "OVER (PARTITION BY key)"
    keyed = _keys(nodes).select(
        "a", "b", F.expr(f"min(a) {w}").alias("least"), F.expr(f"count(*) {w}").alias("members"), "key")
    star = (keyed.where("b IS NOT NULL OR members > 1")
            .select("a", F.coalesce("b", "least").alias("b")).where("a <> b").distinct())
    star = C.written(star, "stars")
    met = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    met = C.written(nodes.join(met, "node"), "met")
    sa = met.select(F.col("node").alias("a"), F.col("sig").alias("sa"), F.col("n_shingles").alias("na"))
    sb = met.select(F.col("node").alias("b"), F.col("sig").alias("sb"), F.col("n_shingles").alias("nb"))
    near = (star.join(sa, "a").join(sb, "b")
            .where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
            .select("a", "b", _distance("sa", "sb").alias("d")).where(F.col("d") <= LOOK)
            .groupBy("a").agg(F.min(F.struct("d", "b")).alias("best")).select("a", "best.b"))

    def sets(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), C.long_list([g.view(np.int64) for g in shingle_sets(part.column(1), shingle)])],
                    ["node", "grams"])

    wanted = texts.join(_sized(met.select(F.col("node").alias("doc_id"))), "doc_id")
    sets = C.written(wanted.mapInArrow(C.lean(sets), "node long, grams array<long>"), "grams")
    links = C.written(_confirmed(near, sets, num, den), "confirmed")
    comps = C.components(links)

    # step 4: keys whose members are still apart
    comp = (met.select("node", "sig").join(comps, "node", "left")
            .withColumn("comp", F.coalesce("component", "node")).drop("component"))
    apart = _apart(comp)
    chains = C.written(_families(_in_blocks(apart, "key")).distinct(), "families")
    family = C.components(chains).withColumnRenamed("component", "family")
    together = family.join(comp.select("node", "comp"), "node").join(sets, "node")
    more = _family_links(_in_blocks(together, "family"), num, den)
    # rows that share a doc_id but not a text are one document
    several = named.groupBy("doc_id").agg(F.min(F.struct("s1", "s2")).alias("x"), F.max(F.struct("s1", "s2")).alias("y"))
    several = C.written(several.where("x <> y").select("doc_id"), "several")
    of_id = (named.join(_sized(several), "doc_id", "left_semi").select("doc_id", "s1", "s2").distinct()
             .join(reps.select("s1", "s2", F.col("node").alias("a")), ["s1", "s2"]).select("doc_id", "a").distinct())
    first = of_id.groupBy("doc_id").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1")
    repeated = of_id.join(first, "doc_id").where("a <> b").select("a", "b")
    comps = C.merged_components(comps, C.written(more.unionByName(repeated).distinct(), "more"))

    ends = reps.join(comps, "node", "left").select("s1", "s2", "rows", F.coalesce("component", "node").alias("component_id"))
    full = C.joined_by_weight(named, C.written(ends, "ends"), ["s1", "s2"], "rows", named.count())
    alone = signed.where("n_shingles = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return full.select(*columns).union(alone.select(*columns)).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                            shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the documents that are linked to one of a smaller id. Rows that share a doc_id stay or
    go together; rows without one stay."""
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])                 # no name can clash
    found = C.written(near_duplicates(docs, id_col, text_col, shingle=shingle, num=num, den=den)
                      .where("NOT kept").select(F.col("doc_id").alias("__linked")).distinct(), "linked")
    return own.join(_sized(found), F.col(f"c{docs.columns.index(id_col)}").cast("long") == F.col("__linked"),
                    "left_anti").toDF(*docs.columns)


def _apart(comp: DataFrame) -> DataFrame:
    """(key, node, sig, comp, ...) of all members of those keys that lie in several components."""
    def run(batches):
        for batch in (b.slice(lo, 2000) for b in batches for lo in range(0, b.num_rows, 2000)):
            keys = masked_keys(sig_matrix(batch.column(1).to_pylist())).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()),
                 pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), VALUES)),
                 pa.array(np.repeat(batch.column(2).to_numpy(zero_copy_only=False), VALUES)),
                 pa.array(np.tile(np.arange(VALUES, dtype=np.int32), batch.num_rows))],
                ["key", "node", "comp", "slot"])

    keyed = comp.mapInArrow(C.lean(run), "key long, node long, comp long, slot int")
    spread = keyed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where(
        "x <> y").select("key")
    return keyed.join(spread, "key").join(comp.select("node", "sig"), "node")
