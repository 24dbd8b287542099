"""The end-to-end link job.

A fold over the enabled matchers: each receives the firms still unmatched and
its proposals fill only NULL links. Between matchers the state is checkpointed
to the shared checkpoint folder, so the plan does not grow with the number of
matchers, earlier matchers never re-run, and a lost executor only costs the
current stage.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import (empty_crosswalk, ensure_all_keys, fill_null_update,
                               match_summary, not_in)
from ..session import ensure_checkpoint_dir
from .matchers import MatcherRegistry, default_registry


def stage_firms(firms: DataFrame) -> DataFrame:
    """Staged copy of the firm table with trimmed ``name`` and ``kuerzel``."""
    return firms.withColumns({"name": F.trim("name"), "kuerzel": F.trim("kuerzel")})


def stage_accounts(accounts: DataFrame) -> DataFrame:
    """Staged account names: ``Id`` and trimmed ``Account_Name``.
    The matchers clean names themselves, so trimming never changes a match."""
    return accounts.select("Id", F.trim("Account_Name").alias("Account_Name"))


def _cut_lineage(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_waterfall(firms: DataFrame, accounts: DataFrame, state: DataFrame,
                  registry: MatcherRegistry, checkpoint: bool = True) -> DataFrame:
    """Run the enabled matchers in order (M3); first match wins.

    An error in a matcher propagates (the job stops); with no enabled matcher
    the state comes back unchanged.
    """
    for matcher in registry.enabled():
        matched = state.where(F.col("id_zoho").isNotNull()).select("rec_id")
        unmatched = not_in(firms, "rec_id", matched)
        proposals = matcher.func(unmatched, accounts)
        state = fill_null_update(state, proposals)
        if checkpoint:
            state = _cut_lineage(state)
    return state


def link(firms: DataFrame, accounts: DataFrame, state: DataFrame | None = None,
         registry: MatcherRegistry | None = None,
         enabled: Iterable[str] | str | None = None,
         checkpoint: bool = True) -> tuple[DataFrame, DataFrame]:
    """Link firms to accounts (M6) -> ``(crosswalk, summary)``.

    Every firm key is added to the state *before* the matchers run, so any
    subset of matchers can fill links (in the reference the address matcher
    alone cannot, because only the name matcher inserts missing keys).
    """
    spark = firms.sparkSession
    registry = registry or default_registry()
    if enabled is not None:
        registry = registry.enable_only(enabled)
    # every matcher reads both inputs; keep them (memory, then disk) for the
    # duration of the job instead of recomputing them per matcher. Only when
    # the state is checkpointed can they be released again before returning.
    firms = stage_firms(firms)
    if checkpoint:
        firms = firms.persist(StorageLevel.MEMORY_AND_DISK)
        accounts = accounts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        state = state if state is not None else empty_crosswalk(spark)
        state = ensure_all_keys(state, firms)
        if checkpoint:
            state = _cut_lineage(state)
        state = run_waterfall(firms, accounts, state, registry, checkpoint=checkpoint)
    finally:
        if checkpoint:
            firms.unpersist()
            accounts.unpersist()
    return state, match_summary(state)
