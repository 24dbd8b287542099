"""Secret scanning: keyword automaton, anchored patterns at its hits, embedded checksums.

One Aho-Corasick pass over a text finds every keyword that can start a secret.
Only there are patterns tried, anchored at the hit; a whole-text pattern is
used for long hexadecimal runs alone, which no keyword announces. Formats that
carry a checksum are reported only if it holds.

Kinds, in this order:

``assign``   a credential name, ``:`` or ``=``, and a value of 12 or more characters
``access``   ``AKIA`` and capitals or digits, 18 or more characters in all
``hex``      16 or more hexadecimal digits (lower case)
``github``   ``gh?_`` tokens whose last six base-62 digits are the CRC-32 of the 30 before
``npm``      ``npm_`` tokens, checked the same way

Matches of a kind are leftmost and do not overlap; kinds may overlap each
other. Positions count code points, ends are exclusive. A NULL or empty text has
no spans; repeated rows are scanned and returned each; texts are scanned whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "github", "npm")

# fixed values: keywords and patterns of the kinds
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS_WORD = "akia"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CHECKED_WORDS = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
                 "npm_": "npm"}
CHECKED = r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:int,stop:int>>"


def checksum_holds(body: str, digits: str) -> bool:
    """The last six base-62 digits of such tokens are the CRC-32 of the rest."""
    value = 0
    for ch in digits:
        value = value * 62 + BASE62.index(ch)
    return value == zlib.crc32(body.encode("ascii"))


def scanner():
    """A function from text to its spans ``[(kind, start, stop)]``, sorted by start, then kind."""
    import ahocorasick

    words = ahocorasick.Automaton()
    for w in ASSIGN_WORDS:
        words.add_word(w, ("assign", len(w)))
    words.add_word(ACCESS_WORD, ("access", len(ACCESS_WORD)))
    for w, kind in CHECKED_WORDS.items():
        words.add_word(w, (kind, len(w)))
    words.make_automaton()
    assign = re.compile(ASSIGN, re.I | re.A)
    access, hexa, checked = (re.compile(p, re.A) for p in (ACCESS, HEX, CHECKED))
    rank = {k: i for i, k in enumerate(KINDS)}

    def scan(text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        # only A-Z change case, so positions stay those of the text
        lowered = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode(
            "utf-8", "surrogatepass")
        spans = [("hex", m.start(), m.end()) for m in hexa.finditer(text)]
        hits = sorted((end - size + 1, kind) for end, (kind, size) in words.iter(lowered))
        done = dict.fromkeys(KINDS, 0)
        for at, kind in hits:
            if at < done[kind]:
                continue
            if kind == "assign":
                m = assign.match(text, at)
                good = m is not None and len(m.group(2)) >= ASSIGN_VALUE
            elif kind == "access":
                m = access.match(text, at)
                good = m is not None
            else:
                m = checked.match(text, at)
                good = m is not None and checksum_holds(m.group(1), m.group(2))
            if m is not None:
                done[kind] = m.end()
                if good:
                    spans.append((kind, at, m.end()))
        spans.sort(key=lambda s: (s[1], rank[s[0]]))
        return spans

    return scan


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All secret spans of each document: ``(doc_id, spans)``, one row per input row.

    ``spans`` is an array of (kind, start, stop), empty where nothing is found.
    Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            found = [[{"kind": k, "start": a, "stop": b} for k, a, b in scan(t)]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=kind)], names=["doc_id", "spans"])

    return rows.mapInArrow(scan_batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret span of ``text_col`` replaced by ``mark``; overlapping spans become one mark.

    All other columns are kept as they are; NULL stays NULL.
    """
    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner()

        def one(text):
            if text is None:
                return None
            pieces, at = [], 0
            for _, a, b in scan(text):
                if a >= at:
                    pieces += [text[at:a], mark]
                at = max(at, b)
            return "".join([*pieces, text[at:]])

        for s in parts:
            yield pd.Series([one(t) for t in s], dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))
