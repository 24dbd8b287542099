"""Removal of long repeated byte strings, by sorting sampled suffixes and inducing the rest.

A byte goes if a ``LENGTH``-byte string covering it also starts in a document with a smaller id.
A suffix array answers that by sorting all suffixes and comparing neighbours. Sorting every
suffix would move the corpus many times over, so, as in induced sorting, only a sample is
sorted and the others' common prefixes are induced from it:

1. **Sample.** Of the ``GRAM``-byte strings inside a ``LENGTH``-byte window, the one of least
   hash (leftmost if equal) is the window's anchor. Equal windows have equal anchors, so a
   string can repeat only if its anchor does. About one byte in fifteen is an anchor.
2. **Sort the sample.** Anchors travel packed, a slice of the key range in one row, four bytes
   of key and as few of the document as its id needs; anchors of one document only drop out.
   A batch sends an anchor once however many of its documents hold it.
3. **Induce.** The windows that share an anchor occurrence form one stretch of text. Stretches
   meet by anchor, sorted by Spark's external, spilling sort. Stretches that repeat as a whole
   settle all their windows at once; the others, the ends of repeated runs, are settled window
   by window beside them. An anchor with very many stretches (``CROWD``) is not held in one
   task: its windows go on one by one, as keys of their own, to grouped minima.

Each step keeps the smallest document of a key and refers the others to it. Later copies of a
whole text are settled by its digest. Stretch and window hashes have 64 bits beside the key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import Powers, blocks, likely_in, mix, stage

LENGTH, GRAM = 50, 20
WINDOW = LENGTH - GRAM + 1
#: A slice of keys is meant for this much text; keys have 32 bits below the slice number.
SLICE_BYTES, MIN_SLICE_BITS, MAX_SLICE_BITS = 32 << 20, 8, 20
#: Stretches of one anchor that a task holds at most.
CROWD = 20_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class Suffixes:
    """Anchors of one block: ``row`` (document), ``at`` (position of the anchor), ``low``/``high``
    (first and last window start that it stands for) and ``key``; positions are within the block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, powers: Powers, slice_bits: int) -> None:
        n = len(data)
        self.offsets = offsets
        up, self.down = powers.upto(n + 1)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.total[1:])
        none = np.zeros(0, np.int64)
        self.row = self.at = self.low = self.high = none
        self.key = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        grams = self.hash(np.arange(n - GRAM + 1), GRAM)
        value = (grams >> np.uint64(32)).astype(np.uint32)
        place = np.arange(len(value), dtype=np.int32)
        width = 1
        while width < WINDOW:  # least value of ever wider windows; the left one wins a tie
            step = min(width, WINDOW - width)
            right = value[step:] < value[:-step]
            place = np.where(right, place[step:], place[:-step])
            value = np.where(right, value[step:], value[:-step])
            width += step
        inside = np.zeros(n + 1, dtype=np.int32)  # window starts whose bytes are all of one document
        size = np.diff(offsets)
        some = offsets[:-1][size >= LENGTH]
        inside[some] += 1
        inside[offsets[1:][size >= LENGTH] - LENGTH + 1] -= 1
        starts = np.flatnonzero(np.cumsum(inside[:len(place)]) > 0)
        if not len(starts):
            return
        at = place[starts].astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], cut])
        self.at, self.low = at[first], starts[first]
        self.high = starts[np.concatenate([cut - 1, [len(starts) - 1]])]
        self.row = np.searchsorted(offsets, self.at, side="right") - 1
        self.key = grams[self.at] & np.uint64((1 << (32 + slice_bits)) - 1)

    def hash(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of the strings at ``start``."""
        return string_hash(self.total, self.down, start, length)


def string_hash(total: np.ndarray, down: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Hashes of strings from the running sums of a buffer."""
    return mix((total[start + length] - total[start]) * down[start])


def pack(ids: np.ndarray, base: int, width: int) -> bytes:
    """Ids above ``base`` in ``width`` bytes each."""
    return np.ascontiguousarray((ids - base).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, base: int, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.reshape(-1).view("<i8") + base


SAMPLE = "slice int, base long, width int, keys binary, docs binary, again_keys binary, again_docs binary"


def sample(docs: DataFrame, slice_bits: int) -> DataFrame:
    """Packed anchors of ``docs`` (doc_id, text): per batch and slice each anchor with its smallest
    document, and beside them the anchors' further documents, which are known to repeat it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for lo, _, data, offsets in blocks(batch.column(1)):
                s = Suffixes(data, offsets, powers, slice_bits)
                parts.append((s.key, ids[lo + s.row]))
            if not parts:
                continue
            key, doc = (np.concatenate(p) for p in zip(*parts))
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, doc = key[new], doc[new]
            if not len(key):
                continue
            first = np.ones(len(key), dtype=bool)
            first[1:] = key[1:] != key[:-1]
            base = int(doc.min())
            width = max(1, (int(doc.max()) - base).bit_length() + 7 >> 3)
            place = (key >> np.uint64(32)).astype(np.int32)
            slices, cuts = np.unique(place, return_index=True)
            rows = []
            for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(key)])):
                f = first[a:b]
                low, own = key[a:b].astype("<u4"), doc[a:b]
                rows.append((int(slices[k]), base, width, low[f].tobytes(), pack(own[f], base, width),
                             low[~f].tobytes(), pack(own[~f], base, width)))
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             names=[c.split()[0] for c in SAMPLE.split(", ")])

    return docs.mapInArrow(run, SAMPLE)


def repeated_anchors(docs: DataFrame, slice_bits: int) -> DataFrame:
    """Anchors that occur in several documents, per document: ``(doc_id, keys)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def settle() -> pa.RecordBatch:
            slice_ = np.uint64(held[0][0]) << np.uint64(32)
            key = np.concatenate([np.frombuffer(h[3], "<u4") for h in held]).astype(np.uint64)
            doc = np.concatenate([unpack(h[4], h[1], h[2]) for h in held])
            key2 = np.concatenate([np.frombuffer(h[5], "<u4") for h in held]).astype(np.uint64)
            doc2 = np.concatenate([unpack(h[6], h[1], h[2]) for h in held])
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            twice = np.zeros(len(key) + 1, dtype=bool)
            twice[1:-1] = key[1:] == key[:-1]
            several = twice[:-1] | twice[1:] | np.isin(key, key2)
            key, doc = np.concatenate([key[several], key2]), np.concatenate([doc[several], doc2])
            order = np.argsort(doc, kind="stable")
            key, doc = key[order] | slice_, doc[order]
            cuts = np.flatnonzero(np.concatenate([[len(doc) > 0], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, int)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([cuts, [len(doc)]]).astype(np.int32)), _signed(key))
            return pa.RecordBatch.from_arrays([_longs(doc[cuts]), lists], names=["doc_id", "keys"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield settle()
                    held = []
                held.append(row)
        if held:
            yield settle()

    packed = sample(docs, slice_bits).repartition("slice").sortWithinPartitions("slice")
    found = packed.mapInArrow(run, "doc_id long, keys array<long>")
    return found.groupBy("doc_id").agg(F.flatten(F.collect_list("keys")).alias("keys"))


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values).astype(np.int64), pa.int64())


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


STRETCHES = "key long, doc_id long, node long, start int, inside int, piece binary"


def stretches(docs: DataFrame, slice_bits: int) -> DataFrame:
    """Stretches of the repeated anchors of ``docs`` (doc_id, node, text, keys): where each starts in its
    document, where in it the anchor lies, and its bytes (80 at most)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            ids, nodes, wanted = (batch.column(i).to_numpy(zero_copy_only=False) if i < 2 else batch.column(i) for i in (0, 1, 3))
            for lo, _, data, offsets in blocks(batch.column(2)):
                s = Suffixes(data, offsets, powers, slice_bits)
                bounds = np.searchsorted(s.row, np.arange(len(offsets)))
                keep = np.zeros(len(s.row), dtype=bool)
                for r in range(len(offsets) - 1):
                    a, b = bounds[r], bounds[r + 1]
                    if b > a:
                        keep[a:b] = np.isin(s.key[a:b], wanted[lo + r].values.to_numpy(zero_copy_only=False).view(np.uint64))
                which = np.flatnonzero(keep)
                low, size = s.low[which], s.high[which] - s.low[which] + LENGTH
                ends = np.cumsum(size)
                take = np.repeat(low - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
                piece = pa.Array.from_buffers(pa.binary(), len(which), [
                    None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(data[take].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [_signed(s.key[which]), _longs(ids[lo + s.row[which]]), _longs(nodes[lo + s.row[which]]),
                     pa.array((low - offsets[s.row[which]]).astype(np.int32)),
                     pa.array((s.at[which] - low).astype(np.int32)), piece],
                    names=[c.split()[0] for c in STRETCHES.split(", ")])

    return docs.select("doc_id", "node", "text", "keys").mapInArrow(run, STRETCHES)


def _settle(key: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
    """Which entries have a smaller document with the same key."""
    order = np.lexsort((doc, *key))
    same = np.ones(len(doc), dtype=bool)
    same[:1] = False
    for k in key:
        k = k[order]
        same[1:] &= k[1:] == k[:-1]
    group = np.cumsum(~same) - 1
    least = doc[order][~same]
    out = np.zeros(len(doc), dtype=bool)
    out[order] = doc[order] > least[group]
    return out


RESOLVED = "key long, hash long, doc_id long, node long, start int, stop int, settled boolean"


def resolve(rows: DataFrame) -> DataFrame:
    """Settle stretches and their windows among the stretches of their anchor.

    Rows that are settled are spans to remove. Rows that are not are windows of crowded anchors,
    still to be referred to each other by ``key`` and ``hash``.
    """
    def out(key, value, doc, node, start, stop, settled) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [_signed(key), _signed(value), _longs(doc), _longs(node), pa.array(start.astype(np.int32)),
             pa.array(stop.astype(np.int32)), pa.array(np.full(len(key), settled))],
            names=[c.split()[0] for c in RESOLVED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        crowded = None

        def columns(table: pa.Table) -> tuple:
            table = table.combine_chunks()
            key, doc, node, start, inside = (table.column(i).to_numpy() for i in range(5))
            for _, _, data, offsets in blocks(table.column(5), 1 << 62):
                up, down = powers.upto(len(data) + 1)
                total = np.zeros(len(data) + 1, dtype=np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
            return key.view(np.uint64), doc, node, start.astype(np.int64), inside.astype(np.uint64), offsets, total, down

        def windows(rows_, key, doc, node, start, offsets, total, down) -> tuple:
            count = (np.diff(offsets) - LENGTH + 1)[rows_]
            each = np.repeat(rows_, count)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            return (key[each], string_hash(total, down, offsets[each] + inner, LENGTH), doc[each], node[each],
                    start[each] + inner)

        def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key, doc, node, start, inside, offsets, total, down = columns(table)
            size = np.diff(offsets)
            whole = mix(string_hash(total, down, offsets[:-1], size) + inside * np.uint64(0x9E3779B97F4A7C15))
            done = _settle([whole, key], doc)
            yield out(key[done], whole[done], doc[done], node[done], start[done], (start + size)[done], True)
            rest = np.flatnonzero(~done)
            # an anchor whose stretches are all alike has nothing left to settle
            order = rest[np.lexsort((whole[rest], key[rest]))]
            k, w = key[order], whole[order]
            unlike = np.unique(k[1:][(k[1:] == k[:-1]) & (w[1:] != w[:-1])])
            rest = rest[np.isin(key[rest], unlike)]
            key, value, doc, node, at = windows(rest, key, doc, node, start, offsets, total, down)
            done = _settle([value, key], doc)
            yield out(key[done], value[done], doc[done], node[done], at[done], at[done] + LENGTH, True)

        def spread(table: pa.Table) -> pa.RecordBatch:
            key, doc, node, start, _, offsets, total, down = columns(table)
            key, value, doc, node, at = windows(np.arange(len(key)), key, doc, node, start, offsets, total, down)
            return out(key, value, doc, node, at, at + LENGTH, False)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column(0).to_numpy()
            if not len(keys):
                continue
            cut_ = int(np.searchsorted(keys, keys[-1]))  # rows before the batch's last key are complete
            if cut_ or (held and held[-1].column(0)[0].as_py() != keys[0]):
                held.append(batch.slice(0, cut_))
                table = pa.Table.from_batches(held)
                if crowded is not None:
                    own = np.asarray(table.column(0)) == crowded
                    if own.any():
                        yield spread(table.filter(pa.array(own)))
                        table = table.filter(pa.array(~own))
                    crowded = None
                if table.num_rows:
                    yield from settle(table)
                held = []
            held.append(batch.slice(cut_))
            if crowded is not None or sum(b.num_rows for b in held) > CROWD:
                crowded = int(keys[-1])
                yield spread(pa.Table.from_batches(held))
                held = []
        if held:
            table = pa.Table.from_batches(held)
            if crowded is not None and crowded == table.column(0)[0].as_py():
                yield spread(table)
            else:
                yield from settle(table)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, RESOLVED)


def cut(docs: DataFrame) -> DataFrame:
    """Apply the intervals of ``docs`` (doc_id, node, text, spans): ``(doc_id, node, removed, kept_sha256)``.

    ``removed`` are the maximal removed runs as (start, stop) byte positions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            runs, digests = [], []
            spans = batch.column(3)
            for lo, _, data, offsets in blocks(batch.column(2)):
                for r in range(len(offsets) - 1):
                    text = data[offsets[r]:offsets[r + 1]]
                    mine = spans[lo + r].values
                    edge = np.zeros(len(text) + 1, dtype=np.int32)
                    np.add.at(edge, mine.field(0).to_numpy(zero_copy_only=False), 1)
                    np.add.at(edge, mine.field(1).to_numpy(zero_copy_only=False), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    runs.append([{"start": a, "stop": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())])
                    digests.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(runs, kind), pa.array(digests, pa.string())],
                names=["doc_id", "node", "removed", "kept_sha256"])

    return docs.select("doc_id", "node", "text", "spans").mapInArrow(
        run, "doc_id long, node long, removed array<struct<start:bigint,stop:bigint>>, kept_sha256 string")


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removed runs per document: ``(doc_id, n_bytes, removed, kept_sha256)``, one row per input row.

    Texts are UTF-8 bytes, NULL is empty, whole texts are used, and matches stay within a
    document. Strings are judged on the input. Rows that repeat an id and a text get the same
    runs; texts that share an id never remove each other's bytes. A row without id loses
    nothing and removes nothing. Texts under 50 bytes are untouched. An empty table gives an
    empty result. Ids are longs; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.xxhash64("doc_id", "text"))
    facts = stage(rows.select("doc_id", "node", F.octet_length("text").cast("long").alias("n_bytes"),
                              F.sha2(F.col("text").cast("binary"), 256).alias("sha256")), "suffix-facts")
    # later copies of a whole text are settled by its digest
    first = (facts.where(f"doc_id is not null and n_bytes >= {LENGTH}").groupBy("sha256")
             .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
             .select("sha256", "first"))
    facts = stage(facts.join(first, "sha256", "left").withColumn(
        "copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("first"), "suffix-facts")
    settled_ids = facts.groupBy("doc_id").agg(F.min("copy").alias("copy")).where("copy").select("doc_id")

    total = facts.agg(F.sum("n_bytes")).first()[0] or 0
    slice_bits = min(MAX_SLICE_BITS, max(MIN_SLICE_BITS, int(total // SLICE_BYTES).bit_length()))
    texts = rows.where(f"doc_id is not null and octet_length(text) >= {LENGTH}")
    flagged = repeated_anchors(texts.select("doc_id", "text"), slice_bits).join(settled_ids, "doc_id", "left_anti")
    # node tells texts apart that share an id; 0 for all others
    shared_ids = facts.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    flagged = stage(flagged.join(shared_ids.select("doc_id", F.lit(True).alias("shared")), "doc_id", "left"), "suffix-anchors")
    node = F.when(F.col("shared"), F.col("node")).otherwise(F.lit(0).cast("long")).alias("node")
    work = likely_in(texts, "doc_id", flagged.select("doc_id")).join(flagged, "doc_id").select("doc_id", node, "text", "keys")
    found = stage(resolve(stretches(work, slice_bits)), "suffix-resolved")
    crowd = found.where("not settled")
    least = crowd.groupBy("key", "hash").agg(F.min("doc_id").alias("least"))
    gone = (found.where("settled").select("doc_id", "node", "start", "stop").unionByName(
        crowd.join(least, ["key", "hash"]).where("doc_id > least").select("doc_id", "node", "start", "stop")))
    spans = stage(gone.groupBy("doc_id", "node").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "suffix-spans")
    ids = spans.select("doc_id")
    again = (likely_in(texts, "doc_id", ids)
             .join(shared_ids.select("doc_id", F.lit(True).alias("shared")), "doc_id", "left")
             .select("doc_id", F.col("node").alias("true_node"), node, "text"))
    trimmed = cut(again.join(spans, ["doc_id", "node"]).select("doc_id", F.col("true_node").alias("node"), "text", "spans"))
    trimmed = trimmed.dropDuplicates(["doc_id", "node"])

    out = facts.join(trimmed, ["doc_id", "node"], "left")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    nothing = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return out.select(
        "doc_id", "n_bytes",
        F.when(F.col("copy"), everything).otherwise(F.coalesce("removed", nothing)).alias("removed"),
        F.when(F.col("copy"), F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"))
