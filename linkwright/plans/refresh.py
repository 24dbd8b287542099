"""Full refresh and key update jobs.

The reference truncates the target before it has read and checked the new
file, so a bad file leaves an empty table. Here validation and casting happen
first and the new content is published as a complete new version.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import flags_to_double, nan_to_null, try_cast_long
from ..operators.state import update_by_key
from ..sources.guards import require_columns, require_rows
from ..sources.publish import publish

# Columns the deals export must hold; they are boolean flags loaded as double.
DEALS_FLAG_COLUMNS = ("via_angebote", "Locked__s", "AP_ist_Entscheider")


def prepare_refresh(df: DataFrame, float_cols: Iterable[str] = ()) -> DataFrame:
    """Validate (non-empty, required columns), cast flags to double (P7) and
    turn NaN into NULL (P8). Raises ``ValueError`` before anything is written."""
    float_cols = list(float_cols)
    require_columns(df, float_cols)
    require_rows(df, "refresh input")
    return nan_to_null(flags_to_double(df, float_cols))


def full_refresh(df: DataFrame, base: str, float_cols: Iterable[str] = (),
                 version: str | None = None) -> str:
    """Replace the table at ``base`` with ``df`` (M7): validate, cast, then
    publish a new version and flip the pointer. Returns the version."""
    return publish(prepare_refresh(df, float_cols), base, version)


def cast_update_ids(updates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text id columns -> bigint with the oracle's ``try_cast`` rules."""
    return updates.withColumns({c: try_cast_long(F.col(c)) for c in columns})


def update_from_text(target: DataFrame, updates: DataFrame, key: str,
                     columns: Sequence[str], flag: str | None = "updated") -> DataFrame:
    """Key update job (M8): text updates cast to bigint, then
    ``UPDATE target SET cols FROM updates WHERE key = key``. A value that does
    not cast becomes NULL and overwrites (as in the reference); a key that does
    not cast never matches. ``flag`` marks updated rows (A7)."""
    typed = cast_update_ids(updates, [key, *columns])
    return update_by_key(target, typed, key, columns, flag=flag)


def rows_updated(updated: DataFrame, flag: str = "updated") -> int:
    """Number of rows the update touched."""
    return updated.where(F.col(flag)).count()
