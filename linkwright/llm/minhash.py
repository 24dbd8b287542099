"""Near-duplicate groups by b-bit MinHash.

A document's set is its distinct 5-word shingles (A-Z lower-cased; a shorter
text is one shingle; no word, empty set). Two documents are linked when the sets'
Jaccard similarity is at least ``percent`` / 100; a group is a connected component.

1. One pass over the texts gives per document the set size, a digest of the
   set, ``BANDS`` band keys of ``ROWS`` minima each, and the low ``BITS`` bits of
   all minima packed into longs. Documents of equal sets become one class.
2. Band keys are grouped; the class whose buckets are largest in sum heads a bucket: in a group of copies
   of one text that is the text itself, whatever its id. Every class is first held against one class only, the one
   that heads most of its buckets.
3. A pair goes on if the set sizes allow the similarity and the b-bit
   signatures, with chance agreements (1 in 2^b) corrected for, come within
   ``SLACK`` of it; then it is confirmed on the full sets.
4. Confirmed links are contracted. Buckets whose classes are all in one
   component by now are done; in the others the classes outside the bucket's
   smallest component meet the classes of other components. Pairs in one component are never listed.
5. Classes that were held against the same head H in step 2 keep their difference to it. The difference of two
   of them follows from these, ``X ^ Y = (X ^ H) ^ (Y ^ H)``, and so does their exact similarity. So in a group
   whose members are below the threshold of H and of each other, pairs are compared in the bucket, but none of
   them is listed, and no text moves for it. Other pairs go on as in 3. Differences of over ``MAX_DIFFERENCE``
   shingles are not kept; such pairs, too, go on as in 3.

Two documents at the threshold share no bucket with probability
(1 - s^ROWS)^BANDS = 5e-6 at s = 0.75, and less above it. ``SLACK`` is four standard
deviations of the estimate at the threshold. Nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import Powers, Words, blocks, connected_components, likely_in, mix, shingle_hashes, stage

BANDS, ROWS, BITS = 32, 4, 4
PERMUTATIONS = BANDS * ROWS
LONGS = PERMUTATIONS * BITS // 64
SLACK = 0.16
#: A class keeps its difference to its head if the estimate is within this of the similarity.
HEAD_SLACK, MAX_DIFFERENCE = 0.4, 512


class Signer:
    """Signatures of shingle sets; the permutations are the same in every task."""

    def __init__(self) -> None:
        seeds = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.mul = seeds[:PERMUTATIONS] | np.uint64(1)
        self.add = seeds[PERMUTATIONS:]
        self.band = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        self.shift = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))

    def minima(self, values: np.ndarray) -> np.ndarray:
        low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(values), 512):
            v = values[a:a + 512, None] * self.mul
            v += self.add
            np.minimum(low, v.min(axis=0), out=low)
        return low

    def sign(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and packed low bits."""
        low = mix(self.minima(values))
        keys = self.band.copy()
        for r in range(ROWS):
            keys = mix(keys ^ low[r::ROWS])
        bits = (low & np.uint64((1 << BITS) - 1)).reshape(LONGS, 64 // BITS)
        return keys.view(np.int64), np.bitwise_or.reduce(bits << self.shift, axis=1).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, class, keys, bits)`` of ``docs`` (doc_id, text); class is NULL for empty sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, signer = Powers(), Signer()
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                words = Words(data, offsets)
                size, digest, keys, bits = [], [], [], []
                for h in shingle_hashes(words, words.hashes(powers)):
                    h = np.unique(h)
                    size.append(len(h))
                    if len(h):
                        digest.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                        k, b = signer.sign(h)
                        keys.append(k)
                        bits.append(b)
                    else:
                        digest.append(None)
                full = np.array([d is not None for d in digest])
                lists = []
                for rows, width in ((keys, BANDS), (bits, LONGS)):
                    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
                    ends = np.concatenate([[0], np.cumsum(full * width)]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), *lists],
                    names=["doc_id", "n_shingles", "class", "keys", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles long, class binary, keys array<long>, bits array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures: agreement, corrected for chance."""
    ones = F.lit(0x1111111111111111)
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(ones))
    chance = 1.0 / (1 << BITS)
    return ((1.0 - differ / F.lit(float(PERMUTATIONS))) - chance) / (1.0 - chance)


def possible(n_a: Column, bits_a: Column, n_b: Column, bits_b: Column, percent: int, slack: float = SLACK) -> Column:
    """Sizes allow the similarity (less what the slack adds to SLACK), and the estimate comes within ``slack`` of it."""
    least = percent - round(100 * (slack - SLACK))
    return ((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * least)
            & (estimate(bits_a, bits_b) >= percent / 100 - slack))


def reaches(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return common * 100 >= (n_a + n_b - common) * percent


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with whether their full sets reach the similarity (``linked``), and the sets' symmetric
    ``difference`` (NULL above MAX_DIFFERENCE); ``texts`` is (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()

        def sets(column: pa.Array) -> Iterator[np.ndarray]:
            for _, _, data, offsets in blocks(column):
                words = Words(data, offsets)
                for h in shingle_hashes(words, words.hashes(powers)):
                    yield np.unique(h)

        for batch in batches:
            linked, apart = [], []
            for x, y in zip(sets(batch.column(2)), sets(batch.column(3))):
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(bool(common) and 100 * common >= percent * (len(x) + len(y) - common))
                far = len(x) + len(y) - 2 * common > MAX_DIFFERENCE
                apart.append(None if far else np.setxor1d(x, y, assume_unique=True).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_()),
                                              pa.array(apart, pa.list_(pa.int64()))], names=["a", "b", "linked", "difference"])

    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    # an inner join: a semi join would be moved in front of the filter, and every text shuffled
    texts = stage(likely_in(texts, "doc_id", wanted).join(wanted, F.col("doc_id") == F.col("node")).drop("node"),
                  "minhash-texts")
    sides = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
             .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))
    return sides.select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long, linked boolean, difference array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """Group of each document: ``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    ``component_id`` is the smallest id of the group, ``kept`` whether the row bears it. Texts
    without a word (or NULL) have an empty set and are their own group. Rows that repeat an id
    count as one document: they are in one group. A row with a NULL id takes the group of the
    rows of equal set, or none (NULL, kept). An empty table gives an empty result. Ids are longs;
    other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stage(signatures(texts), "minhash-signatures")
    named = signed.where("class is not null and doc_id is not null")
    classes = stage(named.groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
        F.first("bits").alias("bits")), "minhash-classes")
    owner = classes.select("class", "rep")
    reps = classes.select("rep", "n", "bits")
    texts = texts.where("doc_id is not null")

    buckets = classes.select(F.explode("keys").alias("key"), "rep")
    crowds = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    crowded = stage(buckets.join(crowds, "key"), "minhash-buckets")
    weight = crowded.groupBy("rep").agg(F.sum("crowd").alias("weight"))
    weighed = crowded.join(weight, "rep").select("key", "rep", "weight")
    head = F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("best")
    heads_of = weighed.groupBy("key").agg(head).select("key", (-F.col("best.minus")).alias("head"))
    members = stage(crowded.select("key", "rep").join(heads_of, "key"), "minhash-members")

    def checked(pairs: DataFrame) -> DataFrame:
        return stage(confirm(stage(pairs, "minhash-pairs"), texts, percent), "minhash-links")

    # every class against the class that heads most of its buckets (the smallest of equals): one pair each
    heads = members.where("rep <> head").groupBy("rep", "head").agg(F.count(F.lit(1)).alias("times"))
    heads = (heads.groupBy("rep").agg(F.max(F.struct("times", (-F.col("head")).alias("minus"))).alias("best"))
             .select((-F.col("best.minus")).alias("a"), F.col("rep").alias("b")))
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    likely = possible(F.col("n_a"), F.col("bits_a"), F.col("n_b"), F.col("bits_b"), percent, HEAD_SLACK)
    to_heads = checked(heads.join(left, "a").join(right, "b").where(likely).select("a", "b"))
    links = to_heads.where("linked").select("a", "b")
    # rows of one id with different texts are one document
    ids = named.groupBy("doc_id").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi")
    same = (named.join(ids.select("doc_id"), "doc_id", "left_semi").join(owner, "class").where("doc_id <> rep")
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    groups = connected_components(links.unionByName(same), "minhash-components")

    placed = members.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    # a class's pivot is the head that it was held against
    pivots = to_heads.where("difference is not null").select(F.col("b").alias("rep"), F.col("a").alias("pivot"), "difference")
    open_ = stage(placed.join(mixed.select("key", "low"), "key").join(reps, "rep").join(pivots, "rep", "left"), "minhash-open")
    x, y = open_.where("component > low").alias("x"), open_.alias("y")
    together = F.col("x.n") + F.col("y.n")
    apart = (F.size("x.difference") + F.size("y.difference")
             - 2 * F.size(F.array_intersect("x.difference", "y.difference")))
    known = F.coalesce(F.col("x.pivot") == F.col("y.pivot"), F.lit(False))
    # a pair of a class and its own head was settled before
    settled = F.coalesce((F.col("x.pivot") == F.col("y.rep")) | (F.col("y.pivot") == F.col("x.rep")), F.lit(False))
    rest = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") > F.col("y.component")) & ~settled
                   & possible(F.col("x.n"), F.col("x.bits"), F.col("y.n"), F.col("y.bits"), percent)
                   & (~known | reaches((together - apart) / 2, F.col("x.n"), F.col("y.n"), percent)))
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())
    more = checked(rest).where("linked").select("a", "b")
    if not more.isEmpty():
        # the groups so far are single nodes now
        at = groups.withColumnRenamed("component", "root")
        for side in ("a", "b"):
            more = (more.join(at.withColumnRenamed("node", side), side, "left")
                    .withColumn(side, F.coalesce("root", side)).drop("root"))
        joined = connected_components(more, "minhash-components")
        roots = joined.select(F.col("node").alias("root"), F.col("component").alias("least"))
        groups = (groups.withColumnRenamed("component", "root").join(roots, "root", "left")
                  .select("node", F.coalesce("least", "root").alias("component"))
                  .unionByName(joined.join(groups, "node", "left_anti")))
        groups = stage(groups, "minhash-groups")

    component = groups.withColumnRenamed("node", "rep")
    by_class = owner.join(component, "rep", "left").select("class", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "class").join(by_class, "class", "left")
    group = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", group.alias("component_id"),
                      F.coalesce(F.col("doc_id") == group, F.col("component").isNull()).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``docs`` with one document of each group (the smallest id); of rows that repeat an id, one stays.

    Rows with a NULL id stay.
    """
    found = near_duplicates(docs, id_col, text_col, percent)
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.max("kept").alias("_kept"), F.count("*").alias("_times"))
    keep = ids.where("_kept").select(F.col("doc_id").alias("_id"), "_times")
    named = docs.join(keep, docs[id_col].cast("long") == F.col("_id"))
    once = named.where("_times = 1").select(*[docs[c] for c in docs.columns])
    again = named.where("_times > 1").dropDuplicates(["_id"]).select(*[docs[c] for c in docs.columns])
    return once.unionByName(again).unionByName(docs.where(F.col(id_col).isNull()))
