"""Benchmark decontamination: which short test items lie inside which long documents.

Items and documents are sets of 5-word shingles (A-Z lower-cased; a shorter text
is one shingle; no word, no shingle). An item is *contained* when at least
``threshold`` of its distinct shingles occur in the document.

Search. Items are partitioned by size (powers of two). Each gets a bottom-k MinHash
sketch, with k one more than the shingles an item of its partition may miss, so a
document containing the item holds at least one sketch value: the search loses
nothing, however long the document is. (A sketch of the document would lose
short items in long documents, so documents are looked up whole.) A document
goes on only if it holds enough of the sketch for the containment to be possible.

Verification compares the shingles themselves (bytes, not hashes).

The item index (sketch values and item texts) is broadcast while it has at most
``max_index_values`` values; above that, documents and sketches meet in a
shuffled join on the value. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import SHINGLE_WORDS, Powers, Words, blocks, share, shingle_hashes

THRESHOLD_PERCENT = 75
#: About 16 bytes a value in each task; 4 million are some 64 MB.
MAX_INDEX_VALUES = 4_000_000

OUT = "doc_id {id}, item_id {item}, n_item long, n_common long, containment double"


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> set[bytes]:
    """Distinct word shingles of a text, as bytes."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return set()
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def sketch_size(n: int, percent: int) -> int:
    """Sketch values of an item of ``n`` shingles: one more than the largest item of its partition may miss."""
    upper = 1 << max(0, int(n - 1).bit_length())
    return min(n, upper - -(-upper * percent // 100) + 1)


def needed_hits(n: int, percent: int) -> int:
    """Sketch values that a document containing the item holds at least."""
    return max(1, sketch_size(n, percent) - (n - -(-n * percent // 100)))


def _text_hashes(texts: list[str | None]) -> list[np.ndarray]:
    powers, out = Powers(), []
    column = pa.array(texts, type=pa.large_string())
    for _, _, data, offsets in blocks(column):
        words = Words(data, offsets)
        out += shingle_hashes(words, words.hashes(powers))
    return out


class ItemIndex:
    """Sketch values in order, the items of each, and each item's text."""

    def __init__(self, items: list[tuple], percent: int) -> None:
        self.percent = percent
        rows = [(i, t) for i, t in items if t is not None]
        self.ids = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        values, owners, self.sizes = [], [], []
        for k, h in enumerate(_text_hashes(self.texts)):
            h = np.unique(h)
            self.sizes.append(len(h))
            if len(h):
                part = h[:sketch_size(len(h), percent)]
                values.append(part)
                owners.append(np.full(len(part), k))
        v = np.concatenate(values) if values else np.zeros(0, np.uint64)
        o = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.lexsort((o, v))
        self.values, self.owners = v[order], o[order]
        self.needed = np.array([needed_hits(n, percent) if n else 1 << 30 for n in self.sizes] or [0])
        bits = max(16, int(len(v)).bit_length() + 6)
        self.mask = np.uint64((1 << bits) - 1)
        self.flags = np.zeros(1 << bits, dtype=bool)
        self.flags[(self.values & self.mask).astype(np.int64)] = True
        self.sets: dict[int, set[bytes]] = {}

    def shingles(self, k: int) -> set[bytes]:
        if k not in self.sets:
            self.sets[k] = shingle_set(self.texts[k])
        return self.sets[k]

    def candidates(self, hashes: np.ndarray) -> list[int]:
        """Items of whose sketch the shingles ``hashes`` hold enough."""
        near = hashes[self.flags[(hashes & self.mask).astype(np.int64)]]
        if not len(near):
            return []
        near = np.unique(near)
        lo = np.searchsorted(self.values, near, side="left")
        hi = np.searchsorted(self.values, near, side="right")
        owners = [self.owners[a:b] for a, b in zip(lo, hi) if b > a]
        if not owners:
            return []
        items, hits = np.unique(np.concatenate(owners), return_counts=True)
        return items[hits >= self.needed[items]].tolist()


def _compare(item: set[bytes], doc: set[bytes], percent: int) -> tuple[int, int] | None:
    common = len(item & doc)
    return (len(item), common) if item and 100 * common >= percent * len(item) else None


def bounded_index(items: DataFrame, percent: int, max_index_values: int) -> ItemIndex | None:
    """The index of ``items`` (item_id, item_text) if it has at most ``max_index_values`` values, else None."""
    # a word has two bytes at least with the space after it; sizes are read before any item is
    words = (items.agg(F.sum(F.length("item_text"))).first()[0] or 0) // 2
    if words > 64 * max_index_values:
        return None
    index = ItemIndex([tuple(r) for r in items.collect()], percent)
    return index if len(index.values) <= max_index_values else None


def _item_rows(items: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    return items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("item_text"))


def find_contained(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", percent: int = THRESHOLD_PERCENT,
                   max_index_values: int = MAX_INDEX_VALUES) -> DataFrame:
    """Pairs of a document and an item it contains: ``(doc_id, item_id, n_item, n_common, containment)``.

    NULL or wordless texts are in no pair, on either side; repeated documents or items each
    give their pairs; NULL ids are carried through. Other columns are not read. An empty table
    gives no pairs.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("doc_text"))
    i = _item_rows(items, item_col, item_text_col)
    schema = OUT.format(id=d.schema["doc_id"].dataType.simpleString(), item=i.schema["item_id"].dataType.simpleString())
    index = bounded_index(i, percent, max_index_values)
    if index is not None:
        return _by_broadcast(d, index, i.schema["item_id"].dataType, schema)
    return _by_join(d, i, percent, schema)


def _contained(index: ItemIndex, powers: Powers, texts: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """(row, item number, size of the item, shingles in common) for each item contained in a row's text."""
    for lo, _, data, offsets in blocks(texts):
        words = Words(data, offsets)
        for k, h in enumerate(shingle_hashes(words, words.hashes(powers))):
            found = index.candidates(h)
            own = shingle_set(texts[lo + k].as_py()) if found else set()
            for j in found:
                if (got := _compare(index.shingles(j), own, index.percent)) is not None:
                    yield lo + k, j, *got


def _by_broadcast(d: DataFrame, index: ItemIndex, item_type, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    shared = share(d.sparkSession, index)
    item_arrow = to_arrow_type(item_type)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, powers = shared(), Powers()
        for batch in batches:
            got = list(_contained(index, powers, batch.column(1)))
            row, item, size, common = (list(x) for x in zip(*got)) if got else ([], [], [], [])
            item = [index.ids[j] for j in item]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, item_arrow), pa.array(size, pa.int64()),
                 pa.array(common, pa.int64()),
                 pa.array([c / n for c, n in zip(common, size)], pa.float64())],
                names=["doc_id", "item_id", "n_item", "n_common", "containment"])

    return d.mapInArrow(search, schema)


def _by_join(d: DataFrame, i: DataFrame, percent: int, schema: str) -> DataFrame:
    """The same search for an item table of any size: sketches and shingles meet in a shuffled join.

    Rows that repeat an id and a text are searched once and counted, so each of them has its pairs in the end.
    """
    d = d.groupBy("doc_id", "doc_text").agg(F.count(F.lit(1)).alias("doc_times"))
    i = i.groupBy("item_id", "item_text").agg(F.count(F.lit(1)).alias("item_times"))
    id_type, item_type = (s.schema[c].dataType.simpleString() for s, c in ((d, "doc_id"), (i, "item_id")))

    def distinct_hashes(sketch: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            for batch in batches:
                for lo, _, data, offsets in blocks(batch.column(1)):
                    words = Words(data, offsets)
                    row, value, needed = [], [], []
                    for k, h in enumerate(shingle_hashes(words, words.hashes(powers))):
                        h = np.unique(h)
                        if sketch and len(h):
                            need = needed_hits(len(h), percent)
                            h = h[:sketch_size(len(h), percent)]
                            needed.append(np.full(len(h), need))
                        row.append(np.full(len(h), lo + k))
                        value.append(h)
                    row = np.concatenate(row)
                    columns = [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)) if sketch else None,
                               pa.array(np.concatenate(value).view(np.int64)),
                               pa.array(np.concatenate(needed) if needed else np.zeros(0, np.int64)) if sketch else None]
                    names = ["item_id", "item_text", "value", "needed"] if sketch else ["doc_id", None, "value", None]
                    yield pa.RecordBatch.from_arrays([c for c in columns if c is not None], names=[x for x in names if x])
        return run

    sketches = i.select("item_id", "item_text").mapInArrow(
        distinct_hashes(True), f"item_id {item_type}, item_text string, value long, needed long")
    values = d.select("doc_id", "doc_text").mapInArrow(distinct_hashes(False), f"doc_id {id_type}, value long")
    hits = (values.distinct().join(sketches, "value").groupBy("doc_id", "item_id", "item_text")
            .agg(F.count("*").alias("hits"), F.first("needed").alias("needed")).where("hits >= needed"))
    times = i.select(F.col("item_id").alias("_i"), F.col("item_text").alias("_t"), "item_times")
    pairs = (hits.select(F.col("doc_id").alias("_d"), "item_id", "item_text")
             .join(d, F.col("_d").eqNullSafe(F.col("doc_id")))
             .join(times, F.col("_i").eqNullSafe(F.col("item_id")) & (F.col("_t") == F.col("item_text")))
             .select("doc_id", "doc_text", "item_id", "item_text", (F.col("doc_times") * F.col("item_times")).alias("times")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_compare(shingle_set(t), shingle_set(x), percent) for x, t in
                   zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            keep = [k for k, g in enumerate(got) if g is not None]
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array([got[k][0] for k in keep], pa.int64()),
                 pa.array([got[k][1] for k in keep], pa.int64()),
                 pa.array([got[k][1] / got[k][0] for k in keep], pa.float64()), batch.column(4).take(rows)],
                names=["doc_id", "item_id", "n_item", "n_common", "containment", "times"])

    found = pairs.mapInArrow(verify, schema + ", times long")
    # most pairs occur once; only the others go through the explode
    more = found.where("times > 1").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return found.where("times = 1").drop("times").unionByName(more.drop("times", "_n"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", percent: int = THRESHOLD_PERCENT,
                      max_index_values: int = MAX_INDEX_VALUES) -> DataFrame:
    """``docs`` without the documents that contain an item; columns as they were, each row judged by its own text."""
    i = _item_rows(items, item_col, item_text_col)
    index = bounded_index(i, percent, max_index_values)
    if index is None:
        # the row travels as one value, so that no column of the caller's can meet one made here
        text = F.col(text_col).cast("string")
        keyed = docs.select(F.struct("*").alias("row"), F.sha2(text, 256).alias("node"))
        leaks = _by_join(docs.select(F.sha2(text, 256).alias("doc_id"), text.alias("doc_text")).distinct(), i, percent,
                         OUT.format(id="string", item=i.schema["item_id"].dataType.simpleString()))
        return keyed.join(leaks.select(F.col("doc_id").alias("node")).distinct(), "node", "left_anti").select("row.*")
    shared = share(docs.sparkSession, index)

    @F.pandas_udf("boolean")
    def leaks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, powers = shared(), Powers()
        for s in parts:
            out = np.zeros(len(s), dtype=bool)
            out[[r for r, *_ in _contained(index, powers, pa.array(s, type=pa.large_string(), from_pandas=True))]] = True
            yield pd.Series(out)

    return docs.where(~leaks(F.col(text_col).cast("string")))
