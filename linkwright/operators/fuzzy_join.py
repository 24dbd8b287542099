"""Fuzzy name join without a nested loop.

``a = b OR jaro_winkler(a, b) > threshold`` written as a join condition makes
Spark plan a broadcast nested-loop join over all N*M pairs. Here the same result
comes from equi-joins only:

1. **Equality pairs** -- an equi-join on the name (covers ``'' = ''``).
2. **Budget.** With m matching bytes and t transpositions, ``jaro > J`` means
   ``(|a|-m)/|a| + (|b|-m)/|b| + t/m < 3(1-J)``. For names of at most ``top``
   bytes, the bytes that only one of the two has are therefore fewer than
   ``3(1-J) * top``. J depends on the common prefix of the pair (0 to 4 bytes);
   pairs with a prefix of 1-2 and 3-4 bytes share a key level each, and the
   prefix is part of the key.
3. **Groups (pigeonhole).** A name's bytes are dealt into ``ceil(D / 2)`` groups, where D bounds the unmatched
   bytes of both: in one of the groups at most one byte is unmatched. Bytes are dealt in order of their
   frequency, so groups weigh alike; those beyond the most frequent share a symbol, which only joins names.
4. **Candidate keys.** A key hashes (level, prefix, number of groups, group, how often each of its symbols
   occurs). The right name has one key a group, the left one also those with one symbol more or less. The
   number of groups follows from the longer name, so a name has keys for each number a partner can bring.
   A name too long for its alphabet has the keys of ``_long_keys``: byte tokens by the prefix-filter principle.
5. **Signatures.** A key row carries its name's length and a signature of 256 bits with one
   set for each ``(byte, occurrence#)``; the most frequent have bits of their own. Bits that only one of two signatures has are unmatched bytes, so pairs
   over the budget end inside the join on keys: what is shuffled after it grows with the near names.
6. **Verification** -- distinct candidate pairs pass length and prefix bounds on
   JVM expressions, and the Arrow UDF scores what is left.

Every step is lossless (a colliding hash only adds a candidate), so the result
equals the nested-loop definition. Names are deduplicated first: the work grows
with distinct names, not with rows. Key rows are of fixed size; their
number per name is bounded by its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import (WINKLER_MAX_PREFIX, jaro_winkler_verify_udf,
                                    match_fraction_bounds)
from ..session import ensure_checkpoint_dir

_EPS = 1e-6
_KEY_JOIN_HINT = "merge"
_OCC_RANGE = 1 << 32  # above any occurrence number in a name, so token ids never collide

_KEY_COLUMNS = ["id", "key", "lim", "n", "s0", "s1", "s2", "s3"]
_KEY_SCHEMA = "id long, key long, lim double, n int, s0 long, s1 long, s2 long, s3 long"

# Prefix bytes in the key, and the longest common prefix of the pairs it serves.
LEVELS = ((0, 0), (1, 2), (3, 4))
# The same for the keys of names that are not long.
SHORT_LEVELS = ((0, 0), (1, 1), (2, 2), (3, 4))
# Symbols that a name's bytes are told apart by: the most frequent bytes, and one for all others.
SYMBOLS = 40
# Signature words of 64 bits, bits that tokens share that have none of their own, names whose keys make one Arrow batch.
WORDS, SHARED_BITS, KEY_BATCH = 4, 16, 512
# Of long names. Length classes: the first holds names up to CLASS_BASE bytes, each next one CLASS_STEP times longer ones.
CLASS_BASE, CLASS_STEP = 8, 1.25
# Unmatched bytes that a group may hold, about: one group more for each GROUP_BUDGET bytes of the budget.
GROUP_BUDGET = 4.0
# Tokens in a key by the difference of the two group sizes: one-sided differences leave more subsets.
KEY_TOKENS = (5, 4, 4, 3, 3)


def common_prefix4(a: Column, b: Column) -> Column:
    """Common prefix length of two different UTF-8 encoded names (binary
    columns), in bytes, capped at 4 -- the similarity works on bytes."""
    expr = F.lit(0)
    for k in range(1, WINKLER_MAX_PREFIX + 1):
        expr = F.when(F.substring(a, 1, k) == F.substring(b, 1, k), F.lit(k)).otherwise(expr)
    return expr


def level_budgets(threshold: float) -> list[float]:
    """Per common prefix length l (0..4), ``3 * (1 - J_l)``: what unmatched shares and transpositions may add up to."""
    # the bound is 3 J - 2 with a little slack for the scorer's floating point
    return [1.0 - b for b in match_fraction_bounds(threshold)]


def group_limits(budget: float, top: int) -> tuple[int, int]:
    """(groups, D): groups that the tokens of names up to ``top`` bytes are dealt into, and the most unmatched
    bytes that the best of them can have."""
    groups = max(1, math.ceil((budget * top + _EPS) / GROUP_BUDGET))
    return groups, math.ceil(budget * top / groups + _EPS) - 1


def _raw_tokens(names: DataFrame) -> DataFrame:
    """(name, n, pos, tid): one row per UTF-8 byte (the similarity's unit); ``tid``
    encodes the byte value and its occurrence number counted from the end of the
    name, so equal tokens of two names are equal integers, and the tokens behind
    a prefix are those of the rest of the name. ``n`` is the length in bytes.

    ``names`` comes out of a ``distinct`` and is hash-partitioned by name, so
    the window needs no further shuffle.
    """
    # ASCII names (bytes are characters) split cheaply by character; others
    # by the hex digits of their UTF-8 encoding
    ascii_only = F.octet_length("name") == F.length("name")
    units = F.when(ascii_only, F.expr("regexp_extract_all(name, '(?s).', 0)")).otherwise(
        F.expr("regexp_extract_all(hex(encode(name, 'UTF-8')), '..', 0)"))
    t = (names.where(F.length("name") > 0)
         .select("name", F.octet_length("name").alias("n"), ascii_only.alias("_ascii"),
                 F.posexplode(units).alias("pos", "c")))
    occ = F.row_number().over(Window.partitionBy("name", "c").orderBy(F.col("pos").desc()))
    byte = F.when(F.col("_ascii"), F.ascii("c")).otherwise(F.conv("c", 16, 10)).cast("long")
    return t.select("name", "n", "pos", (byte * _OCC_RANGE + occ).alias("tid"))


def _token_order(raw: DataFrame) -> DataFrame:
    """(tid, f, rank): how often each token occurs, and the frequency rank of its byte (0: most frequent)."""
    freq = raw.groupBy("tid").agg(F.count(F.lit(1)).alias("f"))
    byte = F.expr(f"tid div {_OCC_RANGE}").alias("byte")
    ranks = (freq.groupBy(byte).agg(F.sum("f").alias("w"))     # at most 256 rows
             .select("byte", (F.row_number().over(Window.orderBy(F.desc("w"), "byte")) - 1).alias("rank")))
    return freq.withColumn("byte", byte).join(F.broadcast(ranks), "byte").select("tid", "f", "rank")


def _ordered_tokens(raw: DataFrame, order: DataFrame) -> DataFrame:
    """(name, n, toks): the name's tokens as (f, tid, rank, pos), rarest first (ties by token). Tokens that
    ``order`` does not know count as rarest, bytes it does not know as behind all others."""
    known = raw.join(order, "tid", "left").selectExpr(
        "name", "n", "pos", "tid", "coalesce(f, 0) as f", f"coalesce(rank, cast(256 + tid div {_OCC_RANGE} as int)) as rank")
    return known.groupBy("name", "n").agg(F.array_sort(F.collect_list(F.struct("f", "tid", "rank", "pos"))).alias("toks"))


def _subsets(spark) -> DataFrame:
    """(x, k, places): all k-subsets of the first x + k places; a constant table of some hundred rows."""
    rows = [f"({x}, {k}, array({', '.join(map(str, c))}))" if k else f"({x}, 0, cast(array() as array<int>))"
            for x in range(len(KEY_TOKENS)) for k in range(max(KEY_TOKENS) + 1)
            for c in combinations(range(x + k), k)]
    return spark.sql(f"select * from values {', '.join(rows)} as t(x, k, places)")


def _class_sql(n: str) -> str:
    return f"greatest(0, cast(ceil(ln({n} / {float(CLASS_BASE)}) / {math.log(CLASS_STEP)!r} - 1e-9) as int))"


def _long_keys(tokens: DataFrame, budgets: list[float], left: bool) -> DataFrame:
    """(id, key, lim) for every candidate key of every name, by byte tokens. Within a group of sizes s and s' and at
    most D unmatched bytes, at least ``m = (s + s' - D) / 2`` tokens are common, so the first ``s - m + k`` and
    ``s' - m + k`` of the two, rarest first, share k of them. A key is the hash of (level, prefix, length classes of
    both, group, s, s', k tokens)."""
    levels = ", ".join(f"struct({lvl} as p, {budgets[most]!r}D as budget)" for lvl, most in LEVELS)
    # a partner is n * (1 - budget) to n / (1 - budget) long; the longer class of the two bounds the budget
    rows = (tokens.selectExpr("name", "n", "toks", f"inline(array({levels}))").where("n >= p")
            .selectExpr("*", f"{_class_sql('n')} as cls",
                        f"explode(sequence({_class_sql(f'greatest(1, floor(n * (1 - budget) - {_EPS}))')}, "
                        f"{_class_sql(f'ceil(n / (1 - budget) + {_EPS})')})) as partner")
            .selectExpr("*", f"budget * ceil({float(CLASS_BASE)}D * pow({CLASS_STEP}D, greatest(cls, partner)) + {_EPS}) as whole")
            .selectExpr("*", f"greatest(1, cast(ceil((whole + {_EPS}) / {GROUP_BUDGET}D) as int)) as groups")
            .selectExpr("*", f"cast(ceil(whole / groups + {_EPS}) as int) - 1 as most", "explode(sequence(0, groups - 1)) as g"))
    # bytes are dealt back and forth in order of frequency: 0 .. G-1, G-1 .. 0, ...
    rows = rows.selectExpr(
        "name", "p", "cls", "partner", "g", "most", "budget as lim",
        "transform(filter(toks, t -> t.pos >= p and (t.rank % (2 * groups) = g or t.rank % (2 * groups) = 2 * groups - 1 - g)),"
        " t -> t.tid) as own")
    rows = rows.selectExpr("*", "explode(sequence(-most, most)) as diff")  # the group's tokens are picked before, once
    # unmatched bytes have the parity of the sizes' difference
    rows = (rows.selectExpr("*", "size(own) as s", "most - abs(most - diff) % 2 as odd")
            .where("s + diff >= 0 and abs(diff) <= odd")
            .selectExpr("*", "greatest(0, cast((2 * s + diff - odd) div 2 as int)) as common"))
    sizes = "cls, partner, s, s + diff" if left else "partner, cls, s + diff, s"
    rows = (rows.selectExpr("*", f"least(common, element_at(array{KEY_TOKENS}, abs(diff) + 1)) as k")
            .selectExpr("own", "k", "lim", "s - common as x", "xxhash64(name) as id",
                        f"xxhash64(p, substring(encode(name, 'UTF-8'), 1, p), g, {sizes}, k) as head"))
    toks = ", ".join(f"get(own, get(places, {j}))" for j in range(max(KEY_TOKENS)))
    return rows.join(F.broadcast(_subsets(tokens.sparkSession)), ["x", "k"]).selectExpr("id", f"xxhash64(head, {toks}) as key", "lim")


def _mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all bits; the same in every version, as keys are stored."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def short_limit(budgets: list[float], symbols: int) -> int:
    """Bytes of the longest pair that short keys serve: its groups hold 4/3 symbols or more on average."""
    return int(1.5 * symbols / max(budgets))


class Alphabet:
    """What both sides of a join know of the names' bytes: symbols of bytes, and the tokens with a signature bit of their own."""

    def __init__(self, order: DataFrame) -> None:
        byte = F.expr(f"tid div {_OCC_RANGE}").cast("int")
        ranks = {r["byte"]: r["rank"] for r in order.select(byte.alias("byte"), "rank").distinct().collect()}   # at most 256
        self.symbols = min(SYMBOLS, len(ranks) + 1)
        self.table = np.full(256, self.symbols - 1, dtype=np.int64)
        for byte, rank in ranks.items():
            self.table[byte] = min(rank, self.symbols - 1)
        frequent = order.orderBy(F.desc("f"), "tid").limit(64 * WORDS - SHARED_BITS).select("tid").collect()
        self.tokens = np.sort(np.array([r["tid"] for r in frequent], dtype=np.int64))

    def bits(self, byte: np.ndarray, occ: np.ndarray) -> np.ndarray:
        """Signature bits of tokens; those that are not frequent share the last ones."""
        tid = byte * _OCC_RANGE + occ
        at = np.searchsorted(self.tokens, tid)
        known = np.r_[self.tokens, -1][at] == tid
        shared = (_mix(tid.astype(np.uint64)) % np.uint64(SHARED_BITS)).astype(np.int64)
        return np.where(known, at, 64 * WORDS - SHARED_BITS + shared)


class NameBlock:
    """Names of a batch as arrays: lengths, signatures, symbol counts, and the keys made of these."""

    def __init__(self, names: pa.Array, alphabet: Alphabet) -> None:
        symbols = alphabet.symbols
        values = [x.encode("utf-8", "surrogatepass") for x in names.to_pylist()]
        self.n = np.array([len(v) for v in values], dtype=np.int64)
        flat = np.frombuffer(b"".join(values), dtype=np.uint8).astype(np.int64)
        row = np.repeat(np.arange(len(values)), self.n)
        self.counts = np.bincount(row * symbols + alphabet.table[flat], minlength=len(values) * symbols).reshape(-1, symbols)
        # occurrence numbers of equal bytes of a name
        cell = np.sort(row * 256 + flat)
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        occ = np.arange(len(cell)) - np.repeat(first, np.diff(np.r_[first, len(cell)]))
        bit = alphabet.bits(cell % 256, occ + 1)
        self.sig = np.zeros((len(values), WORDS), dtype=np.uint64)
        np.bitwise_or.at(self.sig, (cell // 256, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        ends = np.zeros((len(values), 4), dtype=np.uint64)
        for k in range(4):
            ends[self.n > k, k] = [v[k] + 1 for v in values if len(v) > k]
        self.prefix = ends

    def keys(self, budgets: list[float], left: bool, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(row, key, budget) arrays of the short keys."""
        symbols = self.counts.shape[1]
        place = np.arange(symbols)
        weight = _mix(place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        lengths = np.arange(limit + 1)
        for level, (p, most) in enumerate(SHORT_LEVELS):
            budget = budgets[most]
            groups = np.maximum(1, np.ceil((budget * lengths + _EPS) / 2).astype(np.int64))
            fit = np.flatnonzero((self.n >= max(p, 1)) & (self.n <= limit))
            n = self.n[fit]
            low, high = groups[n], groups[np.minimum(limit, np.ceil(n / (1 - budget) + _EPS).astype(np.int64))]
            head = np.full(len(fit), level + 1, dtype=np.uint64)
            for k in range(p):
                head = head * np.uint64(257) + self.prefix[fit, k]
            head = _mix(head)
            for g in range(int(low.min(initial=1)), int(high.max(initial=0)) + 1):
                at = np.flatnonzero((low <= g) & (g <= high))
                if not len(at):
                    continue
                # symbols are dealt back and forth in order of frequency: 0 .. G-1, G-1 .. 0, ...
                dealt = np.where(place % (2 * g) < g, place % (2 * g), 2 * g - 1 - place % (2 * g))
                counts = self.counts[fit[at]]
                mass = np.zeros((len(at), g), dtype=np.uint64)
                for s in place:
                    mass[:, dealt[s]] += counts[:, s].astype(np.uint64) * weight[s]
                salt = _mix(np.uint64(g) * np.uint64(1 << 32) + np.arange(1, g + 1, dtype=np.uint64))
                mass = mass + salt + head[at][:, None]
                yield np.repeat(fit[at], g), _mix(mass.ravel()), budget
                if left:
                    around = mass[:, dealt]
                    yield np.repeat(fit[at], symbols), _mix((around + weight).ravel()), budget
                    has = counts > 0
                    yield np.repeat(fit[at], symbols)[has.ravel()], _mix((around - weight)[has]), budget


def _short_keys(names: DataFrame, alphabet: Alphabet, budgets: list[float], left: bool, limit: int) -> DataFrame:
    """(id, key, lim, n, s0 ..) for the short keys of every name of at most ``limit`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, KEY_BATCH):
                part = batch.slice(start, KEY_BATCH)
                ids, block = np.asarray(part.column(0)), NameBlock(part.column(1), alphabet)
                found = list(block.keys(budgets, left, limit))
                if found:
                    row = np.concatenate([f[0] for f in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[row]), pa.array(np.concatenate([f[1] for f in found]).view(np.int64)),
                         pa.array(np.concatenate([np.full(len(f[0]), f[2]) for f in found])), pa.array(block.n[row].astype(np.int32)),
                         *[pa.array(block.sig[row, k].view(np.int64)) for k in range(WORDS)]], names=_KEY_COLUMNS)

    return names.where("name is not null").selectExpr("xxhash64(name) as id", "name").mapInArrow(run, _KEY_SCHEMA)


def _signed(keys: DataFrame, names: DataFrame, alphabet: Alphabet) -> DataFrame:
    """Long keys (id, key, lim) with the length and signature of their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = NameBlock(batch.column(1), alphabet)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(block.n.astype(np.int32)), *[pa.array(block.sig[:, k].view(np.int64)) for k in range(WORDS)]],
                names=["id", *_KEY_COLUMNS[3:]])

    signed = names.selectExpr("xxhash64(name) as id", "name").mapInArrow(run, "id long, " + _KEY_SCHEMA.split(", ", 3)[3])
    return keys.join(signed, "id").select(*_KEY_COLUMNS)


def token_order(*names: DataFrame) -> DataFrame:
    """The order of tokens that keys go by, from one-column tables of distinct names. Both sides of a join need the same
    order; any order gives the same pairs, one that fits the names gives fewer candidates."""
    tids = None
    for df in names:
        found = _raw_tokens(df.select(F.col(df.columns[0]).alias("name"))).select("tid")
        tids = found if tids is None else tids.unionByName(found)
    return _token_order(tids)


def name_keys(names: DataFrame, order: DataFrame, threshold: float, left: bool) -> DataFrame:
    """(id, key, lim, n, s0 ..): the candidate keys of distinct names (column ``name``), as the left or right side of a
    join, with the budget they serve, and each name's length and signature. Of ``order`` the ranks (one row a byte
    value) and the 240 most frequent tokens, and the length of the longest name are read at once."""
    # these rows are few and short, but each makes hundreds of key rows, which AQE cannot see when it
    # merges small partitions: so their number of partitions is fixed. By a hash of the name: a repartition by the name
    # itself gives way to the exchange of a ``distinct`` below it, which AQE merges
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    budgets = level_budgets(threshold)
    alphabet = Alphabet(order)
    limit = short_limit(budgets, alphabet.symbols)
    keys = _short_keys(names.repartition(spread, F.xxhash64("name")), alphabet, budgets, left, limit)
    # pairs with a name over the limit
    edge = math.floor(limit * (1 - max(budgets)) - _EPS)
    longest = names.agg(F.max(F.octet_length("name"))).first()[0]
    if longest is not None and longest > edge:
        long = names.where(F.octet_length("name") > edge)
        tokens = _ordered_tokens(_raw_tokens(long), order).repartition(spread, F.xxhash64("name"))
        keys = keys.unionByName(_signed(_long_keys(tokens, budgets, left), long, alphabet))
    return keys


def met(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a_id, b_id) of names with a key in common whose signatures fit its budget. ``left`` and ``right`` are
    ``name_keys`` with the id renamed."""
    # both key sides grow with the data: never broadcast them (a sort-merge join
    # spills instead of failing, and AQE splits skewed key partitions)
    own = [c for c in _KEY_COLUMNS if c not in ("id", "key")]
    a, b = left.withColumnsRenamed({c: f"a_{c}" for c in own}), right.withColumnsRenamed({c: f"b_{c}" for c in own})
    only = {x: " + ".join(f"bit_count({x}_s{k} & ~{y}_s{k})" for k in range(WORDS)) for x, y in ("ab", "ba")}
    near = F.expr(f"({only['a']}) / a_n + ({only['b']}) / b_n < a_lim + {_EPS}")
    return a.hint(_KEY_JOIN_HINT).join(b, "key").where(near).select("a_id", "b_id")


def scored_pairs(candidates: DataFrame, a_names: DataFrame, b_names: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim) above the threshold of candidate id pairs (a_id, b_id) whose names differ."""
    budgets = level_budgets(threshold)
    spread = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candidates = candidates.select("a_id", "b_id").distinct().repartition(spread, "a_id", "b_id")
    # a hash stands for a name; names of one hash all come back, so none is lost
    found = (candidates.join(a_names.selectExpr("xxhash64(name) as a_id", "name as a"), "a_id")
             .join(b_names.selectExpr("xxhash64(name) as b_id", "name as b"), "b_id").where("a <> b").select("a", "b"))
    # of the distinct pairs, those whose lengths fit the budget of their own common prefix
    lvl = common_prefix4(F.encode("a", "UTF-8"), F.encode("b", "UTF-8"))
    budget = F.element_at(F.array(*[F.lit(b) for b in budgets]), F.col("lvl") + 1)
    la, lb = F.octet_length("a"), F.octet_length("b")
    cand = found.withColumn("lvl", lvl).where(F.abs(la - lb) < budget * F.greatest(la, lb) + _EPS).select("a", "b")
    return (cand.withColumn("sim", jaro_winkler_verify_udf(F.col("a"), F.col("b")))
            .where(F.col("sim") > F.lit(threshold)))


def jaro_winkler_join(left: DataFrame, right: DataFrame, threshold: float = 0.95,
                      left_col: str | None = None, right_col: str | None = None,
                      materialize: bool = True) -> DataFrame:
    """All distinct name pairs ``(a, b, sim)`` with ``a = b`` or ``jw(a, b) > threshold``.

    ``left``/``right`` hold the names in ``left_col``/``right_col`` (default:
    their first column). ``sim`` is the Jaro-Winkler similarity (0.0 for two
    empty names, which still pair by equality). NULL names never pair.

    With ``materialize`` (default) the pairs are computed now and returned as a
    checkpointed DataFrame; otherwise the plan is returned lazily (``name_keys`` tells what is read at once).
    """
    budgets = level_budgets(threshold)
    if group_limits(max(budgets), CLASS_BASE)[1] >= len(KEY_TOKENS):
        raise ValueError("KEY_TOKENS has no entry for the largest difference of group sizes")
    lc = left_col or left.columns[0]
    rc = right_col or right.columns[0]
    a_names = left.select(F.col(lc).alias("name")).where(F.col("name").isNotNull()).distinct()
    b_names = right.select(F.col(rc).alias("name")).where(F.col("name").isNotNull()).distinct()

    # cache what several branches read, only when this call also releases it
    keep = ((lambda df: df.persist(StorageLevel.MEMORY_AND_DISK)) if materialize
            else (lambda df: df))
    a_names, b_names = keep(a_names), keep(b_names)
    equal = a_names.join(b_names, "name").select(
        F.col("name").alias("a"), F.col("name").alias("b"),
        F.when(F.length("name") > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("sim"))

    # one row per (byte, occurrence#); AQE broadcasts it or not, by its measured size
    order = keep(token_order(a_names, b_names))
    ka = name_keys(a_names, order, threshold, True).withColumnRenamed("id", "a_id")
    kb = name_keys(b_names, order, threshold, False).withColumnRenamed("id", "b_id")
    pairs = equal.unionByName(scored_pairs(met(ka, kb), a_names, b_names, threshold))
    if not materialize:
        return pairs
    # the matches are few; write them once to the shared checkpoint folder so
    # later steps do not recompute the candidate join, then free the cache
    ensure_checkpoint_dir(pairs.sparkSession)
    try:
        return pairs.checkpoint(eager=True)
    finally:
        for cached in (a_names, b_names, order):
            cached.unpersist()
