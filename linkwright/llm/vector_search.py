"""Exact top-k by inner product over a vector-approximation file.

1. **One row per vector.** Rows whose whole-number vectors are equal score alike with every query, so they
   collapse to one vector with the ``k + 1`` smallest ids among them; no answer can hold a later one. Copies
   are combined in the task, then by (vector, task group), then by vector.
2. **Approximations.** Each component's range is cut into 64 cells. A vector's cells (a byte a component)
   are its approximation; approximations travel in blocks. The cuts are weighted means of quantiles that all
   tasks report. Any cuts give exact results; good ones make bounds narrow.
3. **Scan of the cells.** A block of queries meets one stripe of the blocks of approximations after the other.
   With each cell's middle ``m`` and half width ``h``, a score lies within ``q.m -+ |q|.h``: two matrix products
   for a pair of blocks. Each query keeps the k + 1 best lower bounds so far, and only vectors whose upper bound
   reaches the last of them go on.
4. **Reading in bound order.** Per query the (k+1)-th lower bound over all stripes drops most of what is left.
   The ``k + 1`` vectors of highest upper bound are read first and scored exactly; the lowest of these scores
   is one that the answer's last row reaches. Only vectors whose upper bound reaches it are read after that,
   so the answer is certain.

The queries are a stated set that is held against all rows, in blocks; the work of the scan is their product.
Equal query vectors are searched once. All steps are joins, windows and grouped sums of Spark; tasks hold a
pair of blocks, and the driver gets the cuts and row counts alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.common import share, stage
from linkwright.llm.vectors import packed, pieces, unpacked, usable, whole_numbers, width_of

SCALE, CELLS = 64, 64
#: Queries and approximations of a block, at most; queries are taken on in steps of STEP.
QUERY_BLOCK, CELL_BLOCK, STEP = 4096, 4096, 64
#: Rows that a task holds at once, and groups that combine a crowded vector's copies before they meet.
BATCH_ROWS, GROUPS = 4096, 1024


def _distinct(rows: DataFrame, k: int, width: int, scale: int) -> DataFrame:
    """``(uid, vector, ids, asked)``: one row per whole-number vector, its k + 1 smallest ids, whether a query has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() % GROUPS
        for table in pieces(batches, BATCH_ROWS):
            whole = whole_numbers(table["vector"], width, scale)
            _, first, same = np.unique(np.ascontiguousarray(whole).view(f"V{4 * width}").ravel(), return_index=True,
                                       return_inverse=True)
            ids = table["id"].combine_chunks()
            missing = np.asarray(ids.is_null())
            value = np.asarray(ids.fill_null(0))
            order = np.lexsort((value, missing, same))
            starts = np.searchsorted(same[order], np.arange(len(first)))
            place = np.arange(len(order)) - starts[same[order]]
            order = order[place <= k]
            offsets = np.searchsorted(same[order], np.arange(len(first) + 1)).astype(np.int32)
            asked = np.zeros(len(first), dtype=bool)
            np.logical_or.at(asked, same, np.asarray(table["asked"].combine_chunks()))
            yield from pa.table({
                "vector": packed(whole[first]), "ids": pa.ListArray.from_arrays(offsets, ids.take(pa.array(order))),
                "asked": asked, "part": np.full(len(first), group, dtype=np.int32)}).to_batches()

    kind = dict(rows.dtypes)["id"]
    found = rows.mapInArrow(run, f"vector binary, ids array<{kind}>, asked boolean, part int")
    fewest = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")
    for keys in (("vector", "part"), ("vector",)):
        found = found.groupBy(*keys).agg(fewest, F.max("asked").alias("asked"))
    return stage(found.select(F.monotonically_increasing_id().alias("uid"), "vector", "ids", "asked"), "search-vectors")


def _cuts(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest value of each cell, by component."""
    inner = np.arange(1, CELLS) / CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pieces(batches, 4 * BATCH_ROWS):
            whole = unpacked(table["vector"], np.int32, width)
            q = np.quantile(whole, inner, axis=0) * len(whole)
            yield pa.RecordBatch.from_pydict({"axis": np.arange(width), "n": np.full(width, len(whole)),
                                              "least": whole.min(axis=0), "most": whole.max(axis=0),
                                              **{f"q{c}": q[c] for c in range(CELLS - 1)}})

    names = [f"q{c}" for c in range(CELLS - 1)]
    got = (vectors.select("vector").mapInArrow(
        run, "axis long, n long, least int, most int, " + ", ".join(f"{q} double" for q in names))
        .groupBy("axis").agg(F.min("least").alias("least"), F.max("most").alias("most"),
                             *[(F.sum(q) / F.sum("n")).alias(q) for q in names])
        .orderBy("axis").toArrow())
    least, most = (np.asarray(got[c]).astype(np.int64) for c in ("least", "most"))
    cut = np.sort(np.floor(np.stack([np.asarray(got[q]) for q in names])).astype(np.int64), axis=0)
    cut = np.clip(cut, least, most)
    # a cell holds cut < value <= next cut
    return np.vstack([least, cut + 1]), np.vstack([cut, most])


def _blocks(vectors: DataFrame, rows: int, encode) -> tuple[DataFrame, int]:
    """``vectors`` in blocks of about ``rows``: ``(number, n, uids, data)`` with ``encode``'s bytes, and their count."""
    parts = max(1, -(-vectors.count() // rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pieces(batches, 1 << 40):  # all of the part
            yield pa.RecordBatch.from_pydict({
                "number": [TaskContext.get().partitionId()], "n": [table.num_rows],
                "uids": [np.asarray(table["uid"], dtype=np.int64).tobytes()], "data": [encode(table)]})

    spread = vectors.select("uid", "vector").repartition(parts)
    return stage(spread.mapInArrow(run, "number long, n long, uids binary, data binary"), "search-blocks"), parts


def _encoder(lows: np.ndarray, width: int):
    def encode(table: pa.Table) -> bytes:
        whole = unpacked(table["vector"], np.int32, width)
        cell = np.empty(whole.shape, dtype=np.uint8)
        for j in range(width):
            cell[:, j] = np.searchsorted(lows[1:, j], whole[:, j], side="right")
        return cell.tobytes()
    return encode


def _scan(met: DataFrame, lows: np.ndarray, highs: np.ndarray, k: int) -> DataFrame:
    """``(query, uid, low, high)``: bounds of what may be among a query's first k + 1.

    ``met`` has a block of queries (``kind`` 0) in front of each stripe of blocks of cells.
    """
    width = lows.shape[1]
    held = share(met.sparkSession, (lows, highs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_lows, own_highs = held()
        middle, half = (own_lows + own_highs) / 2.0, np.maximum(own_highs - own_lows, 0) / 2.0
        reach = np.abs(middle).max(axis=0) + half.max(axis=0)
        axes = np.arange(width)
        queries = q_uids = best = at_set = None
        for batch in batches:
            for i in range(batch.num_rows):
                own_set, kind, n, uids, data = (batch[c][i].as_py() for c in ("set", "kind", "n", "uids", "data"))
                uids = np.frombuffer(uids, dtype=np.int64)
                if kind == 0:
                    queries = np.frombuffer(data, dtype=np.int32).reshape(n, width).astype(np.float64)
                    at_set, q_uids, best = own_set, uids, np.full((n, k + 1), -np.inf)
                    continue
                if own_set != at_set:  # no query fell into this block
                    continue
                cell = np.frombuffer(data, dtype=np.uint8).reshape(n, width)
                mid, wide = middle[cell, axes].T, half[cell, axes].T
                for lo in range(0, len(queries), STEP):
                    q = queries[lo:lo + STEP]
                    size = np.abs(q)
                    slack = (size @ reach)[:, None] * 2.0 ** -40  # above any rounding of the sums
                    score, spread = q @ mid, size @ wide + slack
                    low, high = score - spread, score + spread
                    so_far = np.hstack([best[lo:lo + STEP], low])
                    best[lo:lo + STEP] = np.partition(so_far, n, axis=1)[:, n:]
                    at, who = np.nonzero(high >= best[lo:lo + STEP].min(axis=1)[:, None])
                    yield pa.RecordBatch.from_pydict({"query": q_uids[lo + at], "uid": uids[who], "low": low[at, who],
                                                      "high": high[at, who]})

    return met.mapInArrow(run, "query long, uid long, low double, high double")


def _scored(wanted: DataFrame, vectors: DataFrame, width: int) -> DataFrame:
    """``(query, uid, score, ids)``: exact scores of (query, uid) pairs, both vectors read by their uid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (unpacked(batch[c], np.int32, width).astype(np.int64) for c in ("q_vector", "vector"))
            yield pa.RecordBatch.from_arrays([batch["query"], batch["uid"], pa.array((a * b).sum(axis=1)), batch["ids"]],
                                             ["query", "uid", "score", "ids"])

    asked = vectors.where("asked").select(F.col("uid").alias("query"), F.col("vector").alias("q_vector"))
    rows = wanted.select("query", "uid").join(vectors.select("uid", "vector", "ids"), "uid").join(asked, "query")
    kind = dict(vectors.dtypes)["ids"]
    return rows.select("query", "uid", "q_vector", "vector", "ids").mapInArrow(
        run, f"query long, uid long, score long, ids {kind}")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, vector: str = "embedding", id_column: str = "vec_id",
          scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, id, score)``: for each row where ``queries`` holds, its k rows of highest score.

    The score is the inner product of whole-number vectors ``floor(scale * component)``; ties go to the smaller
    id, NULL ids last. Every row but the query's own takes part: one row of its id and vector is left out, so
    further rows that repeat it are candidates, and each repeated query row has an answer. A condition that is
    NULL for a row makes it no query. With k candidates or fewer all are returned. Vectors that are NULL or hold
    NULL or non-finite components are left out; a shorter vector counts as padded with zeros; components beyond
    ``vectors.largest(width)`` are held to it. Further columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(id_column).alias("id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked"))
    width = max(1, width_of(rows, "vector"))
    kind = dict(rows.dtypes)["id"]
    single = _distinct(rows, k, width, scale)
    asked = single.where("asked")
    if asked.isEmpty():
        return spark.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score long")

    lows, highs = _cuts(single, width)
    tasks = 4 * max(spark.sparkContext.defaultParallelism, 1)
    cells, parts = _blocks(single, int(min(CELL_BLOCK, max(512, single.count() // tasks))), _encoder(lows, width))
    sets, groups = _blocks(asked, QUERY_BLOCK, lambda table: unpacked(table["vector"], np.int32, width).tobytes())
    # every block of queries goes to each stripe, every block of cells to each block of queries
    stripes = min(parts, max(1, -(-tasks // groups)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    sets = sets.withColumn("set", F.col("number")).withColumn("stripe", each(stripes)).withColumn("kind", F.lit(0))
    cells = (cells.withColumn("set", each(groups)).withColumn("stripe", F.col("number") % stripes)
             .withColumn("kind", F.lit(1)))
    met = (sets.unionByName(cells).repartition(groups * stripes, "set", "stripe")
           .sortWithinPartitions("set", "stripe", "kind", "number").select("set", "kind", "n", "uids", "data"))

    by_low, by_high = (Window.partitionBy("query").orderBy(F.col(c).desc(), "uid") for c in ("low", "high"))
    last = F.max(F.when(F.col("place") == k + 1, F.col("low"))).over(Window.partitionBy("query"))
    near = stage(_scan(met, lows, highs, k).withColumn("place", F.row_number().over(by_low)).withColumn("last", last)
                 .where(F.col("last").isNull() | (F.col("high") >= F.col("last")))
                 .select("query", "uid", "high", F.row_number().over(by_high).alias("turn")), "search-near")
    first = stage(_scored(near.where(F.col("turn") <= k + 1), single, width), "search-first")
    reached = first.groupBy("query").agg(F.min("score").alias("reached"))
    rest = _scored(near.where(F.col("turn") > k + 1).join(reached, "query").where("high >= reached"), single, width)

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "uid", "copy")
    answer = (first.unionByName(rest).select("query", "uid", "score", F.posexplode("ids").alias("copy", "id"))
              .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
              .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "uid", "id", "score"))).alias("found")))
    # back to the query rows: one occurrence of the row itself leaves its list
    answer = answer.join(asked.select(F.col("uid").alias("query"), F.col("vector").alias("key")), "query")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["id"], packed(whole_numbers(batch["vector"], width, scale))],
                                             ["query_id", "key"])

    asking = rows.where("asked").select("id", "vector").mapInArrow(keys, f"query_id {kind}, key binary")
    own = F.array_position(F.transform("found", lambda x: (x["uid"] == F.col("query")) & x["id"].eqNullSafe(F.col("query_id"))),
                           True)
    kept = F.slice(F.filter("found", lambda x, i: i + 1 != F.col("own")), 1, k)
    return (asking.join(answer, "key").withColumn("own", own)
            .select("query_id", F.posexplode(kept).alias("at", "row"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("row.id").alias("id"),
                    F.col("row.score").alias("score")))
