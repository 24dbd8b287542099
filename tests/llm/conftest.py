"""Fixtures of the text operators: small messy tables, and brute-force versions to hold results against."""

from __future__ import annotations

import os
import random

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """(doc_id, text, lang, source): NULLs in every column, empty and long texts, copies, near copies, ties."""
    rng = random.Random(3)
    base = [words(rng, rng.randrange(20, 120)) for _ in range(30)]
    rows = [(i, t, ("en", "de")[i % 2], f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, base[i], "en", "s0") for i in range(5)]                                  # exact copies
    rows += [(200 + i, base[i] + " tail", "en", "s0") for i in range(5)]                        # near copies
    rows += [(300 + i, base[10 + i].upper().replace(" ", "\n "), "de", None) for i in range(3)]  # same words
    long = words(rng, 5000, 100_000)
    rows += [(400, long, "en", "s1"), (401, long.replace("w1 ", "w2 "), None, "s1")]
    rows += [(500, None, "en", "s2"), (501, "", None, None), (502, " \n\t ", "de", "s2"), (503, "one two", "en", "s2"),
             (504, "one two", "en", "s2"), (505, "one", "en", None), (506, "# $ % ...", "en", "s0")]
    rows += [rows[3], rows[3], (None, base[4], "en", "s0"), (None, "alone with no id at all here", None, None)]
    rows += [(600, base[6] + " " + words(rng, 300), "en", "s0"), (601, "x" * 200 + "é" * 40, "fr", "s9"),
             (602, "x" * 120 + " other", "fr", "s9"), (603, "one\none\n\none\n two \n two \n", "fr", "s9")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    """The messy table with extra columns whose names clash with the operators' own."""
    schema = ("doc_id long, text string, lang string, source string, node string, key int, size string, component string, "
              "_words int, spans string, keys string, taken string, kept string, score string")
    rows = [(*r, "n", 1, None, "c", 2, "s", "k", "t", "x", "y") for r in messy_rows]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
