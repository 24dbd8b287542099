"""Compression of vectors to one byte a part, with exact nearest entries found through fixed pivots (LAESA).

A vector is cut into equal parts, and each part position has a codebook of whole-number entries. Nearest
entries are searched as LAESA does:

1. Each part position has a few *pivots*, taken once from its first codebook (farthest first) and never moved.
   The distances from every part to its pivots are computed once and stored beside the whole-number vector.
2. In each round only the distances between pivots and entries are new. By the triangle inequality
   ``|d(part, pivot) - d(entry, pivot)|`` is at most ``d(part, entry)``; the largest over the pivots is the bound.
3. A part's entries are taken in the order of their bounds and evaluated exactly, in whole numbers, until the
   next bound is above the best distance found. What is left cannot be nearer, nor tie.
4. A task sums its parts by (part position, entry) and sends these sums alone; Spark adds them up, and the
   driver gets one row per entry (``parts * entries`` rows, whatever the input).

Distances to pivots are kept as 32-bit floats; the bounds give way by more than their rounding, so the
entries found are those of an exhaustive search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import share, stage
from linkwright.llm.vectors import packed, pieces, unpacked, usable, whole_numbers, width_of

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 16, 64, 2, 256, 4
#: Rows that a task holds at once.
BATCH_ROWS = 4096
#: Bounds give way by this share of the distances they come from: more than the rounding of 32-bit floats.
SLACK = 2.0 ** -20
FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (part, entry, component) with the pivots of each part position (part, pivot, component)."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def pivot_distances(self, points: np.ndarray) -> np.ndarray:
        """Distances of points (part, point, component) to the pivots of their part: (part, point, pivot)."""
        gaps = points[:, :, None, :] - self.pivots[:, None, :, :]
        return np.sqrt((gaps * gaps).sum(axis=3).astype(np.float64))


def first_books(rows: np.ndarray, parts: int, pivots: int) -> Codebooks:
    """Codebooks of the given vectors' parts; each position's pivots are chosen farthest first among them."""
    entries = rows.reshape(len(rows), parts, -1).transpose(1, 0, 2).astype(np.int64)
    chosen = np.zeros((parts, min(pivots, len(rows))), dtype=np.int64)
    for p in range(parts):
        away = np.full(len(rows), FAR)
        for j in range(1, chosen.shape[1]):
            away = np.minimum(away, ((entries[p] - entries[p, chosen[p, j - 1]]) ** 2).sum(axis=1))
            chosen[p, j] = away.argmax()
    return Codebooks(entries, np.take_along_axis(entries, chosen[:, :, None], axis=1))


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower), squared distance and number of exact evaluations per point."""
    n, m = len(points), len(entries)
    bound = np.zeros((n, m))
    for p in range(entry_pivots.shape[1]):
        a, b = to_pivots[:, p, None].astype(np.float64), entry_pivots[None, :, p]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable")
    best, at, tried = np.full(n, FAR), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    live = np.arange(n)
    for rank in range(m):
        entry = order[live, rank]
        go = bound[live, entry] <= best[live]  # bounds only grow from here, so a point that stops is settled
        live, entry = live[go], entry[go]
        if not live.size:
            break
        gap = points[live] - entries[entry]
        away = (gap * gap).sum(axis=1)
        better = (away < best[live]) | ((away == best[live]) & (entry < at[live]))
        won = live[better]
        best[won], at[won] = away[better], entry[better]
        tried[live] += 1
    return at, best, tried


def assign(table: pa.Table, books: Codebooks, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For stored rows: parts (row, part, component), and by (row, part) entry, squared distance and evaluations."""
    parts, n = len(books.entries), table.num_rows
    points = unpacked(table["whole"], np.int32, width).astype(np.int64).reshape(n, parts, -1)
    to_pivots = unpacked(table["to_pivots"], np.float32, parts * books.pivots.shape[1]).reshape(n, parts, -1)
    of_entries = books.pivot_distances(books.entries)
    found = [nearest(points[:, p], to_pivots[:, p], books.entries[p], of_entries[p]) for p in range(parts)]
    return points, *(np.stack([f[i] for f in found], axis=1) for i in range(3))


def _measured(rows: DataFrame, books: Codebooks, width: int, scale: int) -> DataFrame:
    """The stored form: id, label, whole-number vector and its parts' distances to the pivots."""
    held, parts = share(rows.sparkSession, books), len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held()
        for table in pieces(batches, BATCH_ROWS):
            whole = whole_numbers(table["vector"], width, scale)
            away = own.pivot_distances(whole.reshape(len(whole), parts, -1).transpose(1, 0, 2).astype(np.int64))
            away = away.transpose(1, 0, 2).reshape(len(whole), -1).astype(np.float32)
            yield from pa.table({"id": table["id"], "label": table["label"], "whole": packed(whole),
                                 "to_pivots": packed(away)}).to_batches()

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, whole binary, to_pivots binary")


def _sums(stored: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Rows and component sums per (part position, entry)."""
    held, step = share(stored.sparkSession, books), width // len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held()
        parts, m = own.entries.shape[:2]
        count, total = np.zeros(parts * m, dtype=np.int64), np.zeros((parts * m, step), dtype=np.int64)
        for table in pieces(batches, BATCH_ROWS):
            points, at, _, _ = assign(table, own, width)
            cell = (at + np.arange(parts) * m).ravel()
            count += np.bincount(cell, minlength=parts * m)
            np.add.at(total, cell, points.reshape(len(cell), step))
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"part": seen // m, "entry": seen % m, "n": count[seen],
                                          **{f"s{j}": total[seen, j] for j in range(step)}})

    axes = [f"s{j}" for j in range(step)]
    sums = stored.mapInArrow(run, ", ".join(f"{c} long" for c in ("part", "entry", "n", *axes)))
    return sums.groupBy("part", "entry").agg(F.sum("n").alias("n"),
                                             *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in axes])


def compress(vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", label: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks | None]:
    """``(codes, codebooks)``: per vector ``(id, label, code, error, evaluated)`` and the final codebooks.

    ``code`` has an entry index for each part position, two hex digits each; ``error`` is the sum of squared
    distances to the entries, in whole numbers of ``floor(scale * component)``; ``evaluated`` counts the exact
    distances computed for the final codes (without bounds: parts times entries).

    Vectors that are NULL or hold NULL or non-finite components are left out. A vector shorter than the
    longest, or a length that the parts do not divide, counts as padded with zeros. Components beyond
    ``vectors.largest(width)`` are held to it, so that errors fit a long. The codebooks start from the rows of
    smallest id (NULL ids last, ties by the vector); with fewer rows than ``entries`` they have fewer entries.
    Repeated rows and NULL ids or labels are rows like others; further columns are not looked at. Without
    usable vectors there are no codes, and the codebooks are None.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry index has two hex digits: entries must be 1 to 256")
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(id_column).alias("id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"),
        F.col(vector).alias("vector"))
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long, evaluated long"
    longest = width_of(rows, "vector")
    start = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    if not start.num_rows:
        return vectors.sparkSession.createDataFrame([], schema), None
    width = max(1, -(-longest // parts)) * parts
    books = first_books(whole_numbers(start["vector"], width, scale), parts, pivots)
    stored = stage(_measured(rows, books, width, scale), "vector-parts")
    for _ in range(rounds):
        moved = books.entries.copy()
        for r in _sums(stored, books, width).collect():  # at most parts * entries rows
            moved[r["part"], r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(moved.shape[2])]
        books = Codebooks(moved, books.pivots)
    held = share(vectors.sparkSession, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held()
        digits = np.array([f"{i:02x}" for i in range(256)])
        for table in pieces(batches, BATCH_ROWS):
            _, at, away, tried = assign(table, own, width)
            code = ["".join(row) for row in digits[at]]
            yield from pa.table({"id": table["id"], "label": table["label"], "code": pa.array(code, pa.string()),
                                 "error": away.sum(axis=1), "evaluated": tried.sum(axis=1)}).to_batches()

    return stage(stored.mapInArrow(run, schema), "vector-codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over equal labels, NULL labels together (NULL beyond a long).

    The sums are combined before the shuffle; AQE takes them by broadcast where they are small and splits
    a crowded label otherwise.
    """
    sums = codes.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
