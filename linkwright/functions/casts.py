"""Casts and NULL normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, StringType

# The text tokens pandas reads as missing by default. The
# reference loads CSV exports with pandas, so these become NULL.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast_long(c) -> Column:
    """Text -> bigint like the oracle's ``try_cast(x AS int64)`` (F10):
    integers as is (surrounding spaces allowed), decimals and exponent forms
    rounded half away from zero (``'2.5'`` -> 3, ``'1e3'`` -> 1000), anything
    else or out of range -> NULL. Large ids never pass through double, and a
    plain decimal is rounded by its first decimal digit alone, however many
    follow. Hex and ``1_000`` forms are not accepted (documented difference)."""
    c = _col(c).cast("string")
    exact = c.try_cast("bigint")
    plain = r"^\s*([+-]?)([0-9]*)\.([0-9]*)\s*$"
    part = lambda i: F.regexp_extract(c, plain, i)
    whole = F.when(part(2) == "", "0").otherwise(part(2))
    up = F.when(part(3).rlike("^[5-9]"), F.lit(1)).otherwise(F.lit(0))
    size = whole.try_cast("decimal(38,0)") + up
    decimal = F.when(part(1) == "-", -size).otherwise(size).try_cast("bigint")
    rounded = F.round(c.try_cast("decimal(38,10)")).try_cast("bigint")
    is_plain = c.rlike(plain) & c.rlike("[0-9]")
    return F.coalesce(exact, F.when(is_plain, decimal).otherwise(rounded))


def na_tokens_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Text columns: the pandas NA tokens become NULL (F17). ``Nil``, ``na``
    and ``-`` stay as they are."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    tokens = [F.lit(t) for t in NA_TOKENS]
    return df.withColumns({
        c: F.when(F.col(f"`{c}`").isin(*tokens), F.lit(None).cast("string"))
            .otherwise(F.col(f"`{c}`")) for c in cols})


def flags_to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Boolean (or boolean text) columns -> double, true 1.0, false 0.0."""
    out = {}
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"missing column {c!r}")
        dt = df.schema[c].dataType
        col = F.col(f"`{c}`")
        if isinstance(dt, StringType):
            col = col.try_cast(BooleanType())
        out[c] = col.cast(DoubleType())
    return df.withColumns(out)


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL in floating columns (P8); other types are NULL already."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in cols})
