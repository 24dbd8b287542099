import random

import pytest

from linkwright.llm import minhash
from linkwright.llm.common import connected_components, likely_in
from linkwright.llm.minhash import keep_one, near_duplicates


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """component per doc_id (rows of one id are one document), by all pairs."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, sa in sets:
        for b, sb in sets:
            if sa and sb and a < b and 100 * len(sa & sb) >= 75 * len(sa | sb):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_groups_equal_brute_force(messy, messy_rows):
    want = brute(messy_rows)
    got = near_duplicates(messy).collect()
    assert len(got) == len(messy_rows)
    sizes = {(r[0], len(shingles(r[1]))) for r in messy_rows}
    for r in got:
        assert (r.doc_id, r.n_shingles) in sizes
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
            assert r.kept == (r.doc_id == want[r.doc_id])
    # a row without id takes the group of its set, or none
    without = sorted(((r.component_id, r.kept) for r in got if r.doc_id is None), key=str)
    assert without == [(4, False), (None, True)]


def test_chain_of_near_copies_is_one_group(spark):
    base = [f"t{i}" for i in range(200)]
    rows = []
    for k in range(60):  # each differs from the one before by little, the ends by much
        text = list(base)
        for j in range(k):
            text[3 * j] = f"e{j}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == brute(rows)


def test_threshold_is_inclusive(spark):
    a = [f"a{i}" for i in range(32)]  # 28 shingles
    # 24 shared shingles of 32: exactly three quarters
    b = a[:28] + [f"b{i}" for i in range(4)]
    c = a[:27] + [f"c{i}" for i in range(5)]
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_keep_one_keeps_columns_and_one_row_per_group(messy, messy_rows):
    kept = keep_one(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    want = brute(messy_rows)
    assert sorted(i for i in ids if i is not None) == sorted({want[i] for i in want})
    assert ids.count(None) == 2


def test_empty(empty):
    assert near_duplicates(empty).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (60, 50), (50, 60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}, 50: 50, 60: 50}


def test_prefilter_loses_no_wanted_row(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    wanted = spark.range(0, 20_000, 7)
    left = likely_in(rows, "doc_id", wanted)
    assert wanted.join(left, wanted["id"] == left["doc_id"], "left_anti").count() == 0
    assert left.count() < 3_200


@pytest.mark.parametrize("n,changed", [(50, 3), (100, 3), (100, 5)])
def test_hub_lists_pairs_in_proportion(spark, monkeypatch, n, changed):
    """An original (largest id) and n copies with words of their own: about n pairs are listed, whether or not
    the copies reach the threshold, and the groups are those of brute force."""
    rng = random.Random(n + changed)
    base = [f"w{i}" for i in range(120)]
    rows = [(10 ** 6, " ".join(base))]
    for i in range(n):
        words = base[:]
        for at in rng.sample(range(10, 110), changed):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    listed = []
    plain = minhash.stage

    def counted(df, purpose):
        out = plain(df, purpose)
        if purpose == "minhash-pairs":
            listed.append(out.count())
        return out

    monkeypatch.setattr(minhash, "stage", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    groups = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert sum(listed) <= 2 * n
    assert groups == brute(rows)
