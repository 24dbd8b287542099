"""Jaro-Winkler goldens, DuckDB parity and the blocking bound."""
import random

import duckdb
import pytest

from linkwright.functions.similarity import jaro_winkler, match_fraction_bounds

GOLDEN = [("martha", "marhta", 0.961111), ("dwayne", "duane", 0.84),
          ("dixon", "dicksonx", 0.813333), ("abcdefgh", "abzzzzzz", 0.5), ("", "", 0.0),
          ("a", "", 0.0), ("abc", "abc", 1.0)]


@pytest.mark.parametrize("a,b,expected", GOLDEN)
def test_golden(a, b, expected):
    assert round(jaro_winkler(a, b), 6) == expected


def test_null():
    assert jaro_winkler(None, "x") is None


def _pairs(n, alpha, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a = "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 16)))
        b = list(a)
        for _ in range(rnd.randint(0, 3)):
            op = rnd.random()
            if op < 0.3 and b:
                b.pop(rnd.randrange(len(b)))
            elif op < 0.6:
                b.insert(rnd.randint(0, len(b)), rnd.choice(alpha))
            elif len(b) > 1:
                i = rnd.randrange(len(b) - 1)
                b[i], b[i + 1] = b[i + 1], b[i]
        out.append((a, "".join(b)))
    return out


@pytest.mark.parametrize("alphabet", ["abcdefg", "aéßb😀ü"])
def test_bitwise_parity_with_duckdb(alphabet):
    """Bit-identical to the oracle, also on non-ASCII text (UTF-8 bytes)."""
    pairs = _pairs(5000, alphabet, 7)
    con = duckdb.connect()
    con.execute("create table p(a varchar, b varchar)")
    con.executemany("insert into p values (?, ?)", pairs)
    for a, b, d in con.execute("select a, b, jaro_winkler_similarity(a, b) from p").fetchall():
        assert jaro_winkler(a, b) == d, (a, b)


@pytest.mark.parametrize("threshold", [0.95, 0.9, 0.8, 0.7])
def test_bound_is_sound(threshold):
    """Every pair above the threshold has more matching chars than B_l * max."""
    bounds = match_fraction_bounds(threshold)
    for a, b in _pairs(20000, "abcde", 11):
        if not a or not b or a == b:
            continue
        s = jaro_winkler(a, b)
        if s > threshold:
            common = sum(min(a.count(c), b.count(c)) for c in set(a))
            lcp = 0
            for x, y in zip(a[:4], b[:4]):
                if x != y:
                    break
                lcp += 1
            assert common > bounds[lcp] * max(len(a), len(b)), (a, b, s)


def test_no_bound_for_low_threshold():
    with pytest.raises(ValueError):
        match_fraction_bounds(0.6)
