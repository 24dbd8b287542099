"""Vector codes and top-k search against exhaustive NumPy versions and their DuckDB SQL."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import queries, vector_codes
from linkwright.llm.oracle import ORACLE_SQL
from linkwright.llm.vector_codes import compress, first_books, nearest, with_label_errors
from linkwright.llm.vector_search import top_k
from linkwright.llm.vectors import largest

NAN, INF = float("nan"), float("inf")


def messy_rows(n=300, width=32, seed=4):
    """(vec_id, embedding, label): NULLs everywhere, ties, repeated rows and ids, short and long vectors."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.2, width).round(2).tolist(), (None, 1, 1, 2, 3)[i % 5]) for i in range(n)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(60)]                         # one vector many times
    rows += [rows[20], rows[20], rows[40], (None, rows[5][1], 1), (None, None, None)]  # repeated rows, NULL ids
    rows += [(60, rng.normal(0, 0.2, width).tolist(), 2)]                          # an id with two vectors
    rows += [(2000, None, 1), (2001, [None] * width, 1), (2002, [NAN] * width, 2), (2003, [0.1] * (width - 1) + [INF], 2),
             (2004, [], 1), (2005, [0.5, -0.5], 1), (2006, [1e30] + [0.0] * (width - 1), 9), (2020, [-1e300] * width, 9)]
    return rows


def whole(rows, scale, width):
    """[(row number, id, label, whole-number vector)] of the usable rows."""
    top, out = largest(width), []
    for i, (vec_id, v, label) in enumerate(rows):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        out.append((i, vec_id, label, [int(min(top, max(-top, np.floor(float(x) * scale)))) for x in v] + [0] * (width - len(v))))
    return out


def brute_codes(rows, width, parts=16, entries=64, rounds=2):
    found = whole(rows, 256, width)
    start = sorted(found, key=lambda r: (r[1] is None, r[1] or 0, rows[r[0]][1]))[:entries]
    step = width // parts
    cut = lambda v: [v[p * step:(p + 1) * step] for p in range(parts)]
    books = [[list(e) for e in b] for b in zip(*(cut(r[3]) for r in start))]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])) for p, x in enumerate(cut(r[3]))]
                for r in found]

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(r[3])[p] for r, a in zip(found, at) if a[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(r[1], r[2], "".join(f"{i:02x}" for _, i in a), sum(d for d, _ in a)) for r, a in zip(found, assign())]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def brute_top(rows, width, k, asked):
    found = whole(rows, 64, width)
    out = []
    for i, vec_id, _, v in found:
        if vec_id is not None and asked(vec_id):
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), c is None, c or 0) for j, c, _, w in found if j != i))[:k]
            out += [(vec_id, r + 1, None if none else c, -s) for r, (s, none, c) in enumerate(scored)]
    return out


def frame(spark, rows):
    """The rows with further columns whose names clash with the operators' own."""
    schema = ("vec_id long, embedding array<double>, label int, id int, vector string, code string, error string, whole string, "
              "query long, uid string, asked string, place string, _label int, rank string")
    return spark.createDataFrame([(*r, 1, "v", "c", "e", "w", 2, "u", "a", "p", 3, "r") for r in rows], schema).repartition(5)


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) if v is not None else (True, 0) for v in r))


def test_codes_equal_exhaustive_search(spark):
    rows = messy_rows()
    codes, books = compress(frame(spark, rows))
    want, digest = brute_codes(rows, 32)
    got = [tuple(r) for r in codes.select("id", "label", "code", "error").collect()]
    assert order(got) == order(want)
    assert books.digest() == digest
    least, most = codes.agg(F.min("evaluated"), F.avg("evaluated")).first()
    assert least >= 16 and most < 0.5 * 16 * 64, "bounds leave most entries out"


def test_label_errors_put_null_labels_together(spark):
    codes, _ = compress(frame(spark, messy_rows(60)).where("coalesce(label, 0) <> 9"))
    got = with_label_errors(codes).collect()
    sums = {}
    for r in got:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert None in sums and all(r["label_error"] == sums[r["label"]] for r in got)


def test_few_rows_and_odd_widths(spark):
    rows = [(1, [0.5] * 17, None), (2, [0.25] * 3, 1), (3, [0.5] * 17, 1)]
    codes, books = compress(frame(spark, rows))
    want, digest = brute_codes(rows, 32)
    assert books.entries.shape == (16, 3, 2) and books.digest() == digest
    assert order(tuple(r) for r in codes.select("id", "label", "code", "error").collect()) == order(want)
    only, books = compress(frame(spark, [(1, [], 1), (2, [], None)]))
    assert [(r["code"], r["error"]) for r in only.collect()] == [("00" * 16, 0)] * 2


def test_no_usable_vector(spark):
    for df in (frame(spark, messy_rows()).limit(0), frame(spark, [(1, None, 1), (2, [None], 2)])):
        codes, books = compress(df)
        assert books is None and codes.count() == 0
        assert top_k(df, F.lit(True)).count() == 0


def test_nearest_keeps_ties_to_the_lower_entry():
    entries = np.array([[[3, 0], [0, 3], [0, 3], [3, 3], [0, 0]]])
    books = vector_codes.Codebooks(entries, entries[:, :2])
    points = np.array([[[0, 0], [3, 3], [0, 3], [2, 2], [100, -100]]])
    at, away, _ = nearest(points[0], books.pivot_distances(points)[0].astype(np.float32), entries[0],
                          books.pivot_distances(entries)[0])
    assert at.tolist() == [4, 3, 1, 3, 0] and away.tolist() == [0, 0, 0, 2, 97 ** 2 + 100 ** 2]


def test_nearest_is_exact_on_random_points():
    rng = np.random.default_rng(1)
    for size in (3, 500, 1 << 20, largest(4)):
        rows = rng.integers(-size, size, (64, 4), endpoint=True)
        books = first_books(rows, 1, 4)
        points = rng.integers(-size, size, (400, 4), endpoint=True)[None]
        at, away, _ = nearest(points[0], books.pivot_distances(points)[0].astype(np.float32), books.entries[0],
                              books.pivot_distances(books.entries)[0])
        d = ((points[0][:, None] - books.entries[0][None]) ** 2).sum(axis=2)
        assert (at == d.argmin(axis=1)).all() and (away == d.min(axis=1)).all()


@pytest.mark.parametrize("k", [1, 20, 1000])
def test_top_k_equals_brute_force(spark, k):
    rows = messy_rows()
    got = [tuple(r) for r in top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k=k).collect()]
    assert order(got) == order(brute_top(rows, 32, k, lambda i: i % 20 == 0))


def test_top_k_with_wide_ranges(spark):
    """Cells far wider than one value: the bounds must still hold."""
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(0, 10.0 ** rng.integers(-2, 4), 12)).tolist(), 0) for i in range(1500)]
    got = [tuple(r) for r in top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, k=7).collect()]
    assert order(got) == order(brute_top(rows, 12, 7, lambda i: i % 50 == 0))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_top_k"])
def test_vector_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{sf_dir}/embeddings.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want.fetchall())
