"""Crosswalk state operators.

The reference mutates a table with INSERT ... NOT IN and UPDATE ... FROM.
Here the state is a DataFrame that each step rewrites; the caller persists it
with one atomic write (or a checkpoint) when a job ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .topk import best_per_group

CROSSWALK_SCHEMA = StructType([
    StructField("rec_id", StringType(), True),
    StructField("id_zoho", StringType(), True),
])


def empty_crosswalk(spark) -> DataFrame:
    """A new crosswalk ``(rec_id, id_zoho)`` with no rows."""
    return spark.createDataFrame([], CROSSWALK_SCHEMA)


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str | None = None) -> DataFrame:
    """Rows of ``df`` where ``col NOT IN (select other_col from other)`` is TRUE.

    SQL three-valued logic: an empty ``other`` keeps every row (NULL keys too);
    a NULL in ``other`` keeps none; otherwise NULL keys are dropped and the rest
    is an anti join. Spark's own NOT IN plan is a null-aware broadcast join and
    becomes a nested loop once ``other`` is too large to broadcast. Here the two
    facts are scalar subqueries of the same lazy plan (one row, no job while it
    is built) and the row work is an equi join.
    """
    other_col = other_col or col
    keys = other.select(F.col(other_col).alias("_k"))
    facts = keys.agg((F.count(F.lit(1)) == 0).alias("none"),
                     (F.count(F.when(F.col("_k").isNull(), 1)) > 0).alias("null")).select(F.struct("none", "null"))
    fact = facts.scalar()
    present = keys.where("_k is not null").distinct().withColumn("_in", F.lit(True))
    joined = df.join(present, F.col(col) == F.col("_k"), "left")
    keep = fact["none"] | (~fact["null"] & F.col(col).isNotNull() & F.col("_in").isNull())
    return joined.where(keep).select(*[df[c] for c in df.columns])


def ensure_all_keys(state: DataFrame, firms: DataFrame, key: str = "rec_id",
                    value: str = "id_zoho") -> DataFrame:
    """Add every firm key missing from the state with a NULL link."""
    new = not_in(firms.select(key), key, state, key).select(
        F.col(key), F.lit(None).cast("string").alias(value))
    return state.select(key, value).unionByName(new)


def fill_null_update(state: DataFrame, proposals: DataFrame, key: str = "rec_id",
                     value: str = "id_zoho", proposal_value: str = "Id") -> DataFrame:
    """``UPDATE state SET value = p.Id FROM p WHERE key = p.key AND value IS NULL``
    (J5): only NULL links are filled, so an earlier match is never overwritten.
    The state keeps its rows: of several proposals for a key (a matcher of the user's own
    may make them) the smallest value counts, NULL proposals last."""
    p = (proposals.select(F.col(key).alias("_pk"), F.col(proposal_value).cast("string").alias("_pv"))
         .where("_pk is not null").groupBy("_pk").agg(F.min("_pv").alias("_pv")))
    joined = state.join(p, state[key] == p["_pk"], "left")
    return joined.select(state[key].alias(key),
                         F.coalesce(state[value], F.col("_pv")).alias(value))


def update_by_key(target: DataFrame, updates: DataFrame, key: str,
                  columns: Sequence[str], dedupe_order: Sequence[tuple[str, bool]] | None = None,
                  check_unique: bool = True, flag: str | None = None) -> DataFrame:
    """``UPDATE target SET c = u.c, ... FROM updates u WHERE target.key = u.key``.

    Matched rows take the update's values, NULL included; unmatched rows keep
    theirs; NULL keys never match. Update keys must be unique: pass
    ``dedupe_order`` to keep the first row per key by that order, otherwise
    duplicates raise ``ValueError`` (the reference leaves the choice to the
    engine). ``flag`` names an optional boolean output column marking the
    updated rows (A7).
    """
    u = updates.where(F.col(key).isNotNull())
    if dedupe_order:
        u = best_per_group(u, [key], dedupe_order, payload=list(columns))
    elif check_unique:
        dup = u.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"update key {key!r} is not unique (e.g. {dup[0][key]!r})")
    u = u.select(F.col(key).alias("_uk"), *[F.col(c).alias(f"_u_{c}") for c in columns],
                 F.lit(True).alias("_matched"))
    joined = target.join(u, target[key] == u["_uk"], "left")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    out = []
    for c in target.columns:
        if c in columns:
            out.append(F.when(matched, F.col(f"_u_{c}").cast(target.schema[c].dataType))
                       .otherwise(target[c]).alias(c))
        else:
            out.append(target[c])
    if flag:
        out.append(matched.alias(flag))
    return joined.select(*out)


def match_summary(state: DataFrame, value: str = "id_zoho") -> DataFrame:
    """One row: total, matched, unmatched and the match rate in percent (A6);
    the rate is 0 for an empty state."""
    agg = state.agg(F.count(F.lit(1)).alias("total_firms"),
                    F.count(value).alias("matched_firms"))
    total, matched = F.col("total_firms"), F.col("matched_firms")
    return agg.select(
        total, matched, (total - matched).alias("unmatched_firms"),
        F.when(total > 0, matched * 100.0 / total).otherwise(F.lit(0.0)).alias("match_rate"))
