"""Helpers shared by the text operators.

Inside tasks, text is handled as Arrow buffers and NumPy arrays: words, word
hashes and shingle hashes of a whole batch come from a few array passes, so no
Python object is made per word. A *word* is a run of bytes other than the six
ASCII white-space bytes (0x20, 0x09-0x0D); for shingles A-Z are lower-cased.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.session import scratch_path

SHINGLE_WORDS = 5
#: Text is worked on in pieces of about this many bytes (whole documents; a longer one is a piece of its own).
BLOCK_BYTES = 1 << 20

# fixed odd multipliers of the word and shingle hashes (arbitrary constants, the same in every task)
_POLY = 0x9E3779B97F4A7C15
_MIX1 = 0xBF58476D1CE4E5B9
_MIX2 = 0x94D049BB133111EB
_SLOT = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
         0x1D8E4E27C47D124F)
_WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    This cuts the lineage in a place every executor can read, so a lost
    executor costs only the tasks that were running on it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text):
    """Number of words of a text column (0 for NULL), as a native expression."""
    ws = r"[\x20\x09-\x0D]"
    squeezed = F.regexp_replace(text, rf"[^\x20\x09-\x0D]+{ws}*", "w")
    # what is left besides one w per word is leading white space
    return F.coalesce(F.length(F.regexp_replace(squeezed, rf"^{ws}+", "")), F.lit(0)).cast("long")


def in_fold(id_col, folds: int, fold: int):
    """crc32 of the id as text, modulo ``folds``, equals ``fold`` (false for a NULL id)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, end row, bytes, offsets)`` pieces of an Arrow text column (NULL: empty)."""
    col = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(_MIX1)
    h ^= h >> np.uint64(27)
    h *= np.uint64(_MIX2)
    h ^= h >> np.uint64(31)
    return h


class Powers:
    """Powers of the hash multiplier and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _POLY), ("down", pow(_POLY, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    white = np.zeros(256, dtype=bool)
    white[list(_WHITE)] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return white, lower


class Words:
    """Words of one block: ``start``, ``end`` (byte positions) and ``first`` (index of each document's first word)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        white, self._lower = _tables()
        self.data, self.offsets = data, offsets
        n = len(data)
        solid = np.zeros(n + 2, dtype=bool)
        solid[1:-1] = ~white[data]
        begins = solid[1:-1] & ~solid[:-2]
        ends = solid[1:-1] & ~solid[2:]
        if n:  # a document's first byte starts a word, its last byte ends one
            inner = offsets[(offsets > 0) & (offsets < n)]
            begins[inner] |= solid[1:-1][inner]
            ends[inner - 1] |= solid[1:-1][inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self, powers: Powers, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word (its bytes, A-Z lower-cased)."""
        n = len(self.data)
        up, down = powers.upto(n + 1)
        letters = (self._lower[self.data] if lower else self.data).astype(np.uint64)
        letters += np.uint64(1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(letters * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])


def shingle_hashes(words: Words, hashes: np.ndarray, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per document the hashes of its word shingles, in text order, repeats kept.

    A document with fewer than ``size`` words has its whole word sequence as one
    shingle; without words it has none.
    """
    slots = [np.uint64(s) for s in _SLOT]
    n = len(hashes)
    rows = max(0, n - size + 1)
    flat = np.zeros(rows, dtype=np.uint64)
    for j in range(size):
        flat += hashes[j:j + rows] * slots[j % len(slots)] + np.uint64(j // len(slots))
    flat = mix(flat)
    out = []
    first = words.first
    for d in range(len(first) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= size:
            out.append(flat[a:b - size + 1])
        elif b > a:
            acc = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for j in range(b - a):
                    acc = acc * np.uint64(_POLY) + hashes[a + j]
            out.append(mix(np.array([acc], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest reachable node for each node that has an edge: ``(node, component)``.

    ``edges`` has long columns ``a`` and ``b``. Alternating star contraction:
    every node hangs its larger neighbours onto its smallest one, then its
    smaller neighbours likewise, until nothing moves. Each step is a grouped
    minimum (combined before the shuffle) and a join; no neighbour list is
    ever gathered, and each round is written out.
    """
    links = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), purpose)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stage(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .where("a <> b").distinct(), purpose)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        links = stage(small, purpose)
        # done when every node hangs on one node, and that one on none
        roles = (links.select(F.col("a").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
                 .unionByName(links.select(F.col("b").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
                 .groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")))
        if roles.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty():
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


FILTER_BITS = 25


def likely_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Those of ``rows`` whose ``column`` may be among the ids of ``wanted`` (one column): a prefilter before a join.

    The ids' hashes set bits in a table of fixed size (2^25 bits, 4 MB), which is broadcast whatever the
    number of ids. No wanted row is lost; with very many ids the filter lets everything pass.
    """
    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))

    ids = wanted.select(place(F.col(wanted.columns[0]).cast("long")).alias("h"))
    bits = ids.groupBy(F.bitmap_bucket_number("h").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_bits"))
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0
    placed = rows.withColumn("_place", place(F.col(column).cast("long"))).withColumn(
        "_number", F.bitmap_bucket_number("_place"))
    return (placed.join(F.broadcast(bits), F.col("_number") == F.col("_bucket")).where(bit)
            .drop("_place", "_number", "_bucket", "_bits"))


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast ``value``; the returned function gives it back inside a task.

    It travels with the definitions of its classes, so executors need no copy of this package.
    """
    box = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(box.value)
