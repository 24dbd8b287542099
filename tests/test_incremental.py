"""Incremental linking equals a full run; the index side of its key join is read in place."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from linkwright import derived
from linkwright.operators.fuzzy_join import name_keys
from linkwright.plans import incremental
from linkwright.plans.incremental import ACCOUNT_COLUMNS, FIRM_COLUMNS, LinkStore, link_delta
from linkwright.plans.link import link


def _firms(spark, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in FIRM_COLUMNS))


def _accounts(spark, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in ACCOUNT_COLUMNS))


FIRMS = [("1", "Nordlicht Energie GmbH", None, "12345", "Hauptstr. 5"), ("2", "Müller & Söhne", None, "12345", "Hauptstr. 7"),
         ("3", None, "Stadtwerke Beispielhausen", None, None), ("4", "Allein", None, "99999", "Weg 1"),
         ("5", "Nordlicht Energi", "x", "12345", "Hauptstr. 5")]
ACCOUNTS = [("b", "Nordlicht Energie", None, None), ("a", "Nordlicht Energie AG", None, None),
            ("c", "Muller und Sohne Nord", "12345", "Hauptstraße 7"), ("d", "Stadtwerke Beispielhausn", None, None),
            ("e", "Müller & Söhne Nord", "12345", "Hauptstraße 7"), ("f", None, None, None), ("g", "Nordlicht Energi", None, None)]


@pytest.mark.parametrize("cuts", [(1, 1, 1), (2, 0, 3), (0, 3, 2)])
def test_deltas_equal_a_full_run(spark, tmp_path, cuts):
    """In any order of arrival, with empty deltas, repeated rows and a new session's store object in between."""
    f1, a1, f2 = cuts
    base = str(tmp_path / "store")
    first = link_delta(LinkStore(spark, base), _firms(spark, FIRMS[:f1]), _accounts(spark, ACCOUNTS[:a1]))
    assert first.count() == f1
    link_delta(LinkStore(spark, base), _firms(spark, FIRMS[:f1 + f2]), _accounts(spark, ACCOUNTS[:a1]))
    got = link_delta(LinkStore(spark, base), _firms(spark, FIRMS[f1:]), _accounts(spark, ACCOUNTS + [(None, "Allein", None, None)]))
    want, _ = link(_firms(spark, FIRMS), _accounts(spark, ACCOUNTS))
    assert rows(got, "rec_id", "id_zoho") == rows(want, "rec_id", "id_zoho")
    again = link_delta(LinkStore(spark, base), _firms(spark, []), _accounts(spark, []))
    assert rows(again) == rows(got)


def test_links_stay_when_asked(spark, tmp_path):
    base = str(tmp_path / "store")
    link_delta(LinkStore(spark, base), _firms(spark, FIRMS), _accounts(spark, [("z", "Nordlicht Energi", None, None)]))
    got = link_delta(LinkStore(spark, base), _firms(spark, []), _accounts(spark, ACCOUNTS), relink="unmatched")
    links = {r["rec_id"]: r["id_zoho"] for r in got.collect()}
    full = {r["rec_id"]: r["id_zoho"] for r in link(_firms(spark, FIRMS), _accounts(spark, ACCOUNTS))[0].collect()}
    assert full["1"] == "b" and full["5"] == "g"
    assert links == {**full, "1": "z", "5": "z"}
    with pytest.raises(ValueError):
        link_delta(LinkStore(spark, base), _firms(spark, []), _accounts(spark, []), relink="sometimes")


def _joins(node):
    """SortMergeJoin nodes of a physical plan."""
    found = [node] if node.nodeName() == "SortMergeJoin" else []
    children = node.children()
    return found + [x for i in range(children.size()) for x in _joins(children.apply(i))]


def test_no_exchange_on_the_index_side(spark, tmp_path):
    store = LinkStore(spark, str(tmp_path / "store"))
    link_delta(store, _firms(spark, []), derived.accounts(spark, SF_SMALL))
    reader = LinkStore(spark, store.base)      # knows the bucketing only by registering the files
    order = spark.read.parquet(f"{store.base}/order")
    names = derived.firms(spark, SF_SMALL).select(F.lower("kuerzel").alias("name")).distinct()
    keys = name_keys(names, order, store.threshold, True).withColumnRenamed("id", "a_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for owner in (store, reader):
            found = owner.candidates(keys, 1)
            top = _joins(found._jdf.queryExecution().executedPlan())[0]
            firms_side, index_side = (top.children().apply(i).toString() for i in (0, 1))
            assert "Exchange" in firms_side
            assert "Exchange" not in index_side and "Bucketed: true" in index_side
            assert found.count() > 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_keys_are_made_in_a_fixed_number_of_tasks(spark, tmp_path):
    """Few short names make many key rows: AQE does not merge their partitions, whatever shuffled them before."""
    store = LinkStore(spark, str(tmp_path / "store"))
    link_delta(store, _firms(spark, []), derived.accounts(spark, SF_SMALL))
    order = spark.read.parquet(f"{store.base}/order")
    names = derived.firms(spark, SF_SMALL).select(F.lower("kuerzel").alias("name")).distinct()
    keys = name_keys(names, order, store.threshold, True)
    used = keys.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_names_with_an_equal_one_meet_equal_names_only(spark, tmp_path, monkeypatch):
    """Firm names that have an equal account, in any version, get no keys; a smaller Id still replaces theirs."""
    keyed = []

    def counted(names, order, threshold, left):
        if left:
            keyed.append(sorted(r["name"] for r in names.collect()))
        return name_keys(names, order, threshold, left)

    monkeypatch.setattr(incremental, "name_keys", counted)
    store = LinkStore(spark, str(tmp_path / "store"))
    firms = _firms(spark, [("1", "Nordlicht Energie", None, None, None), ("2", "Sonnenhof Backwaren", None, None, None)])
    link_delta(store, firms, _accounts(spark, [("m", "Nordlicht Energie", None, None), ("n", "Sonnenhof Backwarn", None, None)]))
    got = link_delta(store, _firms(spark, []), _accounts(spark, [("a", "Nordlicht Energie", None, None), ("b", "Nordlicht Energi", None, None)]))
    assert [k for k in keyed if k] == [["sonnenhofbackwaren"]] * 2
    assert rows(got, "rec_id", "id_zoho") == [("1", "a"), ("2", "n")]
