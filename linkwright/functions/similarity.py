"""Jaro-Winkler similarity and the bounds used to block on it.

The scorer runs through an Arrow-batched pandas UDF: pairs of similar length are
laid out as byte matrices and matched position by position for all of them at once. It is
only ever applied to candidate pairs that survived the native (JVM) filters of
``operators.fuzzy_join``, never inside a join condition. ``jaro_winkler`` is the
same definition for a single pair.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_fma = getattr(math, "fma", lambda x, y, z: x * y + z)

# Fixed values of the Jaro-Winkler definition (they fix the results):
WINKLER_PREFIX_SCALE = 0.1     # boost per common prefix character
WINKLER_MAX_PREFIX = 4         # at most four prefix characters count
WINKLER_BOOST_THRESHOLD = 0.7  # boost only when jaro > 0.7


def jaro_winkler(a: str | None, b: str | None) -> float | None:
    """Jaro-Winkler similarity over the UTF-8 bytes of two strings, like the
    reference's engine (so ``'müller'``/``'muller'`` scores 0.864..., not the
    0.9 a per-character comparison gives); NULL -> NULL, an empty side -> 0.0.
    For ASCII text bytes and characters coincide."""
    if a is None or b is None:
        return None
    return jaro_winkler_seq(a.encode("utf-8"), b.encode("utf-8"))


def jaro_winkler_seq(a, b) -> float:
    """Jaro-Winkler of two sequences (bytes, str, lists of symbols)."""
    la, lb = len(a), len(b)
    if la == 0 or lb == 0:
        return 0.0
    if a == b:
        return 1.0
    window = max(0, max(la, lb) // 2 - 1)
    b_used = [False] * lb
    a_matched = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - window), min(lb, i + window + 1)):
            if not b_used[j] and b[j] == ch:
                b_used[j] = True
                a_matched.append(ch)
                break
    m = len(a_matched)
    if m == 0:
        return 0.0
    b_matched = [b[j] for j in range(lb) if b_used[j]]
    half_transpositions = sum(x != y for x, y in zip(a_matched, b_matched)) // 2
    sim = (m / la + m / lb + (m - half_transpositions) / m) / 3.0
    if sim > WINKLER_BOOST_THRESHOLD:
        prefix = 0
        for x, y in zip(a[:WINKLER_MAX_PREFIX], b[:WINKLER_MAX_PREFIX]):
            if x != y:
                break
            prefix += 1
        # one fused multiply-add, as the oracle computes it (bit-identical ties)
        sim = _fma(prefix * WINKLER_PREFIX_SCALE, 1.0 - sim, sim)
    return sim


#: Matrix cells (pairs x longest name) that one step of the scorer works on.
_CELLS = 1 << 19


def _byte_matrix(values: list[bytes], width: int, pad: int) -> np.ndarray:
    out = np.full((len(values), width), pad, dtype=np.int16)
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
    flat = np.frombuffer(b"".join(values), dtype=np.uint8)
    rows = np.repeat(np.arange(len(values)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _score_block(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Jaro-Winkler of non-empty, different names, one matrix row a pair."""
    la, lb = (np.array([len(x) for x in s]) for s in (a, b))
    ma, mb = _byte_matrix(a, la.max(), -1), _byte_matrix(b, lb.max(), -2)
    window = np.maximum(0, np.maximum(la, lb) // 2 - 1)
    place = np.arange(mb.shape[1])
    free = np.ones(mb.shape, dtype=bool)
    hit = np.zeros(ma.shape, dtype=bool)
    rows = np.arange(len(a))
    for i in range(ma.shape[1]):
        lo, hi = max(0, i - int(window.max())), i + int(window.max()) + 1
        near = free[:, lo:hi] & (mb[:, lo:hi] == ma[:, i, None]) & (np.abs(place[None, lo:hi] - i) <= window[:, None])
        if not near.shape[1]:
            break
        first = near.argmax(axis=1)
        got = near[rows, first]
        hit[got, i] = True
        free[rows[got], lo + first[got]] = False
    m = hit.sum(axis=1)
    # matched bytes of both sides in order, moved to the front
    order_a, order_b = np.argsort(~hit, axis=1, kind="stable"), np.argsort(free, axis=1, kind="stable")
    wide = int(m.max()) if len(m) else 0
    in_a = np.take_along_axis(ma, order_a, axis=1)[:, :wide]
    in_b = np.take_along_axis(mb, order_b, axis=1)[:, :wide]
    half = ((in_a != in_b) & (np.arange(wide)[None, :] < m[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = (m / la + m / lb + (m - half) / m) / 3.0
    sim[m == 0] = 0.0
    short = min(WINKLER_MAX_PREFIX, ma.shape[1], mb.shape[1])
    prefix = np.cumprod(ma[:, :short] == mb[:, :short], axis=1).sum(axis=1)
    boost = np.flatnonzero(sim > WINKLER_BOOST_THRESHOLD)
    # one fused multiply-add, as the oracle computes it (bit-identical ties)
    sim[boost] = [_fma(int(p) * WINKLER_PREFIX_SCALE, 1.0 - s, s) for p, s in zip(prefix[boost], sim[boost].tolist())]
    return sim


def jaro_winkler_pairs(a: list[str | None], b: list[str | None]) -> np.ndarray:
    """``jaro_winkler`` of many pairs at once (NaN for a NULL side)."""
    out = np.full(len(a), np.nan)
    todo = []
    for i, (x, y) in enumerate(zip(a, b)):
        if isinstance(x, str) and isinstance(y, str):
            if x == y and x:
                out[i] = 1.0
            elif not x or not y:
                out[i] = 0.0
            else:
                todo.append((i, x.encode("utf-8"), y.encode("utf-8")))
    todo.sort(key=lambda t: max(len(t[1]), len(t[2])), reverse=True)
    at = 0
    while at < len(todo):
        size = max(1, _CELLS // max(len(todo[at][1]), len(todo[at][2])))
        block = todo[at:at + size]
        out[[t[0] for t in block]] = _score_block([t[1] for t in block], [t[2] for t in block])
        at += size
    return out


@F.pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow-batched Jaro-Winkler over two string columns."""
    found = pd.Series(jaro_winkler_pairs(a.tolist(), b.tolist()), dtype="float64")
    return found.astype(object).where(found.notna(), None)


# The same scorer as a barrier: Catalyst does not push a filter on a
# nondeterministic expression below joins or aggregates, so a ``sim > t`` filter
# stays above the native pruning instead of scoring every raw candidate.
jaro_winkler_verify_udf = jaro_winkler_udf.asNondeterministic()


_BOUND_SLACK = 1e-9


def match_fraction_bounds(threshold: float) -> list[float]:
    """Per common-prefix length l (0..4), a lower bound B_l such that
    ``jaro_winkler(a, b) > threshold`` implies ``m > B_l * max(|a|, |b|)``
    where m counts matching characters.

    Derivation: jw = jaro + 0.1*l*(1-jaro) if jaro > 0.7, else jw = jaro. Hence
    jw > threshold needs jaro > J_l; and jaro <= (m/|a| + m/|b| + 1)/3 with
    m <= min(|a|, |b|) gives m/max > 3*J_l - 2.
    Raises for thresholds where no positive bound exists (no lossless blocking).
    """
    bounds = []
    for l in range(WINKLER_MAX_PREFIX + 1):
        s = WINKLER_PREFIX_SCALE * l
        if threshold >= WINKLER_BOOST_THRESHOLD:
            j = max(WINKLER_BOOST_THRESHOLD, (threshold - s) / (1.0 - s))
        else:
            # jaro <= 0.7 gives jw = jaro, so jaro > threshold is still needed
            j = threshold
        b = 3.0 * j - 2.0
        if b <= 0.0:
            raise ValueError(
                f"threshold {threshold} admits pairs without common characters; "
                "no lossless candidate keys exist (need threshold > 2/3)")
        # the scorer's floating point can land a pair that sits exactly on the
        # threshold just above it; a slightly looser bound keeps such pairs
        bounds.append(b - _BOUND_SLACK)
    return bounds


def prefix_tokens_needed(n: int, bound: float) -> int:
    """Tokens of a name of length n to index so that any partner with
    overlap > bound*n shares one of them (prefix-filter principle)."""
    return n - math.floor(bound * n - 1e-9)
