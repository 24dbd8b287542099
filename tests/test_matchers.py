"""Matcher semantics."""
from pyspark.sql import functions as F

from linkwright.functions.address import parse_address_line
from linkwright.plans.matchers import match_by_address, match_by_name
from conftest import rows

FIRMS = "rec_id string, name string, kuerzel string, plz string, strasse string"
ACCOUNTS = "Id string, Account_Name string, Billing_Code string, Billing_Street string"


def test_empty_names_pair_unless_dropped(spark):
    firms = spark.createDataFrame([("1", "GmbH", None, None, None)], FIRMS)
    acc = spark.createDataFrame([("9", "Corp.", None, None), ("8", "Ltd", None, None)], ACCOUNTS)
    got = rows(match_by_name(firms, acc), "rec_id", "Id", "sim")
    assert got == [("1", "8", 0.0)]          # '' = '' joins with similarity 0, smallest Id
    assert rows(match_by_name(firms, acc, drop_empty_keys=True)) == []


def test_many_to_one_and_name_source(spark):
    firms = spark.createDataFrame([("1", "Acme GmbH", "x", None, None),
                                   ("2", None, "ACME", None, None),     # kuerzel used when name is NULL
                                   ("3", "Other", None, None, None)], FIRMS)
    acc = spark.createDataFrame([("7", "acme", None, None)], ACCOUNTS)
    got = rows(match_by_name(firms, acc), "rec_id", "Id", "sim")
    assert got == [("1", "7", 1.0), ("2", "7", 1.0)]


def test_address_matcher_guard_and_empty_input(spark):
    firms = spark.createDataFrame([
        ("1", "Müller Bau", "x", "10115", "Hauptstraße 5-7"),
        ("2", "Zeta", "x", "10115", "Hauptstraße 5"),           # same address, name refused
        ("3", "Nord", "x", "20095", "Weststr. 12a")], FIRMS)
    acc = spark.createDataFrame([
        ("50", "Mueller Bau Holding", "10115", "Hauptstr. 5"),
        ("51", "Completely Different", "10115", "Hauptstr. 7"),
        ("52", "Nord GmbH", "20095", "Weststraße 12")], ACCOUNTS)
    got = {r.rec_id: r.Id for r in match_by_address(firms, acc).collect()}
    assert got == {"1": "50", "3": "52"}
    assert match_by_address(firms.where(F.lit(False)), acc).count() == 0


def test_parse_address_line(spark):
    lines = ["Hauptstr. 62-64a, 12345, Deutschland", "Linden-Allee 5, 01234, Deutschland",
             "Am Markt, 99999, Deutschland", None]
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    got = [tuple(r["p"]) for r in df.select(parse_address_line("l").alias("p")).collect()]
    assert got == [("hauptstr.", "62-64a", "12345"), ("linden-allee", "5", "01234"),
                   ("am markt", None, "99999"), (None, None, None)]


def test_address_matcher_copies_of_one_firm(spark):
    """A group of copies (same name and address) is matched once and every copy
    gets the answer; the NULL-safe join back is an equi-join, not a nested loop."""
    copies = [(str(i), "Müller Bau", "x", "10115", "Hauptstraße 5") for i in range(40)]
    firms = spark.createDataFrame(copies + [("99", "Zeta", "x", "10115", "Hauptstraße 9")], FIRMS)
    acc = spark.createDataFrame([("50", "Mueller Bau Holding", "10115", "Hauptstr. 5"),
                                 ("49", "Mueller Bau Holding", "10115", "Hauptstr. 5")], ACCOUNTS)
    out = match_by_address(firms, acc)
    got = {r.rec_id: r.Id for r in out.collect()}
    assert got == {str(i): "49" for i in range(40)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
