"""Text cleaning as Spark column expressions.

Everything here returns a ``Column`` built from JVM functions, so it runs inside
whole-stage codegen and never crosses into Python.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Legal-form words removed from company names, as whole ASCII words:
LEGAL_FORMS = ("llc", "inc", "ltd", "corp", "corporation", "plc", "gmbh")
# HTML entity removed from names before anything else:
AMP_ENTITY = "&#38;"
# Street-type spellings removed from German road names:
ROAD_SUFFIX_PATTERN = r"(str\.|str$|str\s|straße|strasse)"
# Latin letters that transliterate without a canonical decomposition (unidecode):
LATIN_EXTRA = {
    "ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "Th", "ı": "i", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T",
    "ŋ": "ng", "Ŋ": "Ng", "ſ": "s", "ß": "ss", "ĸ": "q",
}
# ---------------------------------------------------------------------------

# RE2 (the oracle's regex engine) treats \b as an ASCII word boundary; Java's
# \b also counts accented letters as word characters. Spelling the boundary out
# gives the same matches in both engines.
_ASCII_WORD = "0-9A-Za-z_"
LEGAL_FORM_REGEX = (f"(?<![{_ASCII_WORD}])(" + "|".join(LEGAL_FORMS)
                    + f")(?![{_ASCII_WORD}])")


def _decomposition_table() -> tuple[str, str]:
    """Characters whose canonical decomposition is one base letter plus marks.

    Built by rule from ``unicodedata`` (NFD, drop marks), so the table follows the
    Unicode database instead of being typed in. Stand-alone marks come last,
    without a counterpart: ``translate`` drops those.
    """
    src, dst, marks = [], [], []
    # all planes that hold letters or marks with a canonical decomposition
    for cp in (*range(0xC0, 0x30000), *range(0xE0000, 0xE0200)):
        ch = chr(cp)
        if unicodedata.category(ch) in ("Cs", "Cn"):   # surrogates, unassigned
            continue
        if unicodedata.category(ch)[0] == "M":
            marks.append(ch)
            continue
        nfd = unicodedata.normalize("NFD", ch)
        if nfd == ch:
            continue
        base = "".join(c for c in nfd if unicodedata.category(c)[0] != "M")
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src + marks), "".join(dst)


_ACCENT_SRC, _ACCENT_DST = _decomposition_table()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c) -> Column:
    """Remove diacritics: letters with a canonical decomposition lose their
    marks, stand-alone combining marks are dropped; ``ß ø æ ł`` stay (F3)."""
    return F.translate(_col(c), _ACCENT_SRC, _ACCENT_DST)


def clean_account_name(c) -> Column:
    """Company-name key (F1): drop ``&#38;``, strip accents, lower-case, drop
    legal-form words, keep only ``[a-z0-9]``. NULL stays NULL."""
    c = F.replace(_col(c), F.lit(AMP_ENTITY), F.lit(""))
    c = F.lower(strip_accents(c))
    c = F.regexp_replace(c, LEGAL_FORM_REGEX, "")
    return F.regexp_replace(c, "[^a-z0-9]", "")


def strip_whitespace(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def transliterate_latin(c) -> Column:
    """``unidecode`` for Latin script (F18): decomposable letters lose their
    marks, the few letters without a decomposition map to ASCII."""
    c = strip_accents(c)
    one = {k: v for k, v in LATIN_EXTRA.items() if len(v) == 1}
    c = F.translate(c, "".join(one), "".join(one.values()))
    for k, v in LATIN_EXTRA.items():
        if len(v) > 1:
            c = F.replace(c, F.lit(k), F.lit(v))
    return c


def clean_german_road(c) -> Column:
    """Road key (F15): NULL/'' -> NULL; lower + strip; ``ß``->``ss``; remove the
    street-type spellings anywhere; transliterate; keep ``[a-z0-9]``. May give ''."""
    c = _col(c)
    t = strip_whitespace(F.lower(c))
    t = F.replace(t, F.lit("ß"), F.lit("ss"))
    t = F.regexp_replace(t, "(?U)" + ROAD_SUFFIX_PATTERN, "")
    t = F.regexp_replace(transliterate_latin(t), "[^a-z0-9]", "")
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).otherwise(t)


def split_house_number(c) -> Column:
    """House number range (F16) -> struct(num_1, num_2).

    Split on the first ``-`` or ``/``; each of the first two parts keeps only
    its digits, '' becomes NULL; NULL or '' input gives two NULLs.
    """
    c = _col(c)
    parts = F.split(c, "[-/]")
    digits = lambda p: F.nullif(F.regexp_replace(p, r"(?U)\D", ""), F.lit(""))
    blank = c.isNull() | (c == "")
    null = F.lit(None).cast("string")
    return F.struct(
        F.when(blank, null).otherwise(digits(F.get(parts, 0))).alias("num_1"),
        F.when(blank | (F.size(parts) < 2), null)
         .otherwise(digits(F.get(parts, 1))).alias("num_2"),
    )


def quote_identifier(name: str) -> str:
    """Backtick-quote a column name for use in ``F.col``/SQL."""
    return "`" + name.replace("`", "``") + "`"


def file_stem(path_col) -> Column:
    """File name without folder and last extension."""
    name = F.regexp_extract(_col(path_col), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.[^.]*$", "")
