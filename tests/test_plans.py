"""Plan properties that matter at scale (checked on sf0.001 plans). Every
checked query is also asserted free of nested-loop and cartesian joins in
``test_oracle.py``."""
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from linkwright import derived
from linkwright.operators.fuzzy_join import jaro_winkler_join
from linkwright.operators.state import not_in


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_limits_before_the_shuffle(spark):
    plan = _plan(entry.queries()["best_match_topk"](spark, SF_SMALL))
    partial = plan.find("WindowGroupLimit") != -1 and "Partial" in plan
    assert partial, plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(entry.queries()["best_match_topk"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s.count(":") == 3 for s in schemas), schemas   # 3 of 6 columns


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-test"))


def test_not_in_is_one_lazy_plan_of_equi_joins(spark):
    spark.sparkContext.setJobGroup("plan-test", "building")
    try:
        for name in ("not_in_with_null",):
            df = entry.queries()[name](spark, SF_SMALL)
            plan = _plan(df)
        customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
        before = _jobs(spark)
        _plan(not_in(customers, "c_nationkey", customers, "c_custkey"))
        assert _jobs(spark) == before          # building the plan starts no job
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # a broadcast hash join prints its null-aware flag last: "LeftAnti, BuildRight, true"
    assert not re.search(r"LeftAnti, Build\w+, true", plan)


def _lazy_names(spark):
    firms, accounts = derived.firms(spark, SF_SMALL), derived.accounts(spark, SF_SMALL)
    return jaro_winkler_join(firms.select("kuerzel"), accounts.select("Account_Name"), materialize=False)


def test_lazy_name_join_has_no_nested_loop(spark):
    """On the plan before anything is materialised, so the joins are in it."""
    plan = _plan(_lazy_names(spark))
    assert "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_check_sees_a_naive_join(spark):
    firms, accounts = derived.firms(spark, SF_SMALL), derived.accounts(spark, SF_SMALL)
    naive = firms.join(accounts, F.levenshtein("kuerzel", "Account_Name") < 3)
    assert re.search("NestedLoop|Cartesian", _plan(naive))


def test_each_side_of_a_link_is_scanned_once(spark):
    for side in (derived.firms, derived.accounts):
        assert _plan(side(spark, SF_SMALL)).count("FileScan") == 1
