"""Best row per group.

``QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC, id) = 1`` has two
Spark forms:

* ``best_per_group`` -- an aggregate ``min(struct(sort keys..., payload...))``.
  Hash aggregation combines map-side, so a hot group (a third of all rows in
  one key) is reduced inside each task before the shuffle and never gathered
  in one task.
* ``top_k_per_group`` -- ``row_number`` over a window; Catalyst inserts a
  partial ``WindowGroupLimit`` before the exchange, so each task also ships at
  most k rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sort_key(name: str, descending: bool, numeric: bool) -> Column:
    c = F.col(name)
    if descending:
        if not numeric:
            raise ValueError(f"descending order on non-numeric column {name!r}: "
                             "use top_k_per_group")
        return -c
    return c


def best_per_group(df: DataFrame, keys: Sequence[str],
                   order: Sequence[tuple[str, bool]],
                   payload: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order`` ((column, descending) pairs).

    NULL sort values go last, as in ``ORDER BY ... ASC``/``DESC`` with the
    oracle's NULLS LAST default. Columns not in keys/order/payload are dropped.
    """
    types = dict(df.dtypes)
    numeric = {n for n, t in types.items()
               if t in ("double", "float", "bigint", "int", "smallint", "tinyint")
               or t.startswith("decimal")}
    parts = []
    for i, (name, desc) in enumerate(order):
        parts.append(F.col(name).isNull().alias(f"_n{i}"))
        parts.append(_sort_key(name, desc, name in numeric).alias(f"_k{i}"))
    carried = [c for c in [o for o, _ in order] + list(payload) if c not in keys]
    carried = list(dict.fromkeys(carried))
    parts += [F.col(c).alias(c) for c in carried]
    best = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in carried])


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    k: int = 1, rank_col: str | None = None) -> DataFrame:
    """Rows with ``row_number() <= k`` per group, ``order`` being sort columns.

    Give ``order`` a total order (add a unique column last); ties are otherwise
    arbitrary, as in the reference.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    name = rank_col or "_rn"
    out = df.withColumn(name, rn).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)
