"""Waterfall properties: first match wins, idempotent, one row per firm."""
from pyspark.sql import functions as F

from linkwright import derived
from linkwright.plans.link import link
from linkwright.plans.matchers import MatcherRegistry, default_registry
from conftest import SF_SMALL, rows


def test_waterfall_properties(spark):
    firms, accounts = derived.firms(spark, SF_SMALL), derived.accounts(spark, SF_SMALL)
    state, summary = link(firms, accounts)
    s1 = rows(state)
    assert len(s1) == firms.count() == len({r[0] for r in s1})
    again, _ = link(firms, accounts, state=state)
    assert rows(again) == s1                      # idempotent
    # a pre-set link is never overwritten
    pinned = state.withColumn("id_zoho", F.when(F.col("rec_id") == s1[0][0], "PINNED")
                              .otherwise(F.col("id_zoho")))
    out, _ = link(firms, accounts, state=pinned)
    assert dict(rows(out))[s1[0][0]] == "PINNED"
    r = summary.first()
    assert r.total_firms == len(s1) and r.matched_firms == sum(1 for x in s1 if x[1])


def test_registry_enable_list_and_unique_names():
    reg = default_registry()
    few = reg.enable_only("address_match, unknown")
    assert [m.name for m in few.enabled()] == ["address_match"]
    assert [m.name for m in few.enable_only("").enabled()] == ["address_match"]
    assert len(reg.enabled()) == 2                     # the caller's registry stays as it is
    reg.register("off", lambda f, a: f, enabled=False)
    assert reg.enable_only("off").enabled() == []      # a list only ever turns matchers off
    try:
        reg.register("name_match", lambda f, a: f)
        raise AssertionError("duplicate accepted")
    except ValueError:
        pass


def test_no_enabled_matcher_is_noop(spark):
    firms, accounts = derived.firms(spark, SF_SMALL), derived.accounts(spark, SF_SMALL)
    state, _ = link(firms, accounts, registry=MatcherRegistry())
    assert all(r[1] is None for r in rows(state))
