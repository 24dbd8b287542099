"""NOT IN, fill-NULL and key updates."""
import pytest
from pyspark.sql import functions as F

from linkwright.operators.state import (ensure_all_keys, fill_null_update, match_summary,
                                        not_in, update_by_key)
from conftest import rows


def _df(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_not_in_three_valued(spark):
    left = _df(spark, [("a",), ("b",), (None,)], "k string")
    plain = _df(spark, [("a",)], "k string")
    with_null = _df(spark, [("a",), (None,)], "k string")
    empty = _df(spark, [], "k string")
    assert rows(not_in(left, "k", plain)) == [("b",)]
    assert rows(not_in(left, "k", with_null)) == []
    assert rows(not_in(left, "k", empty)) == [("a",), ("b",), (None,)]


def test_ensure_all_keys_and_fill_null(spark):
    state = _df(spark, [("1", "x"), ("2", None)], "rec_id string, id_zoho string")
    firms = _df(spark, [("1",), ("2",), ("3",)], "rec_id string")
    full = ensure_all_keys(state, firms)
    assert rows(full) == [("1", "x"), ("2", None), ("3", None)]
    prop = _df(spark, [("1", "y"), ("2", "z")], "rec_id string, Id string")
    filled = fill_null_update(full, prop)
    assert rows(filled) == [("1", "x"), ("2", "z"), ("3", None)]   # "1" is not overwritten


def test_update_by_key_overwrites_with_null(spark):
    target = _df(spark, [(1, 10), (2, 20), (None, 30)], "id long, v long")
    upd = _df(spark, [(1, None), (3, 33), (None, 99)], "id long, v long")
    out = update_by_key(target, upd, "id", ["v"], flag="updated")
    assert sorted(rows(out), key=str) == sorted([(1, None, True), (2, 20, False),
                                                 (None, 30, False)], key=str)


def test_update_by_key_rejects_duplicate_keys(spark):
    target = _df(spark, [(1, 10)], "id long, v long")
    upd = _df(spark, [(1, 1), (1, 2)], "id long, v long")
    with pytest.raises(ValueError):
        update_by_key(target, upd, "id", ["v"])
    out = update_by_key(target, upd, "id", ["v"], dedupe_order=[("v", True)])
    assert rows(out) == [(1, 2)]


def test_summary_empty_state(spark):
    empty = _df(spark, [], "rec_id string, id_zoho string")
    r = match_summary(empty).first()
    assert (r.total_firms, r.matched_firms, r.unmatched_firms, r.match_rate) == (0, 0, 0, 0.0)


def test_two_proposals_for_a_key_add_no_row(spark):
    state = spark.createDataFrame([("1", None), ("2", "kept"), (None, None)], "rec_id string, id_zoho string")
    proposals = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", None), ("2", "c"), (None, "d"), (None, "e")],
                                      "rec_id string, Id string")
    assert rows(fill_null_update(state, proposals)) == rows(spark.createDataFrame(
        [("1", "a"), ("2", "kept"), (None, None)], "rec_id string, id_zoho string"))
