"""Scalar goldens."""
import pytest
from pyspark.sql import functions as F

from linkwright.functions.casts import na_tokens_to_null, try_cast_long
from linkwright.functions.text import (clean_account_name, clean_german_road,
                                       split_house_number, strip_accents)

CLEAN = [("Müller & Söhne GmbH", "mullersohne"), ("Straße AG", "straeag"),
         ("A &#38; B Corp.", "ab"), ("GmbHaus", "gmbhaus"), ("GmbH", ""),
         ("Müller_GmbH", "mullergmbh"), ("Gmbhß x", "x"),
         ("Ørsted Łódź Œuvre", "rstedodzuvre"), (None, None),
         ("ACME Corporation", "acme"), ("Big Ltd. & Co LLC", "bigco")]


def _eval(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_clean_account_name(spark):
    got = _eval(spark, [v for v, _ in CLEAN], clean_account_name)
    assert got == [e for _, e in CLEAN]


def test_strip_accents_keeps_letters_without_decomposition(spark):
    got = _eval(spark, ["Ørsted Łódź ß æ é ñ Ü"], strip_accents)
    assert got == ["Ørsted Łodz ß æ e n U"]


def test_clean_german_road(spark):
    values = ["Hauptstraße", "Hauptstr.", "Weststrasse", "Straße", "", None,
              "Linden-Allee", "MÜLLERWEG", " Bahnhofstr "]
    assert _eval(spark, values, clean_german_road) == [
        "haupt", "haupt", "west", "", None, None, "lindenallee", "mullerweg", "bahnhof"]


@pytest.mark.parametrize("value,expected", [
    ("62-64", ("62", "64")), ("62/64", ("62", "64")), ("12a", ("12", None)),
    ("-5", (None, "5")), ("1-2-3", ("1", "2")), ("62–64", ("6264", None)),
    ("", (None, None)), (None, (None, None))])
def test_split_house_number(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    r = df.select(split_house_number("v").alias("h")).first()["h"]
    assert (r["num_1"], r["num_2"]) == expected


def test_try_cast_long(spark):
    values = ["1.5", "2.5", "-2.5", "1e3", " 12 ", "abc", "", "99999999999999999999",
              "386758000060915086", None]
    assert _eval(spark, values, try_cast_long) == [
        2, 3, -3, 1000, 12, None, None, None, 386758000060915086, None]


def test_na_tokens(spark):
    values = ["NA", "N/A", "n/a", "null", "NULL", "None", "nan", "NaN", "#N/A", "<NA>", "",
              "Nil", "na", "-", "x"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in na_tokens_to_null(df).collect()]
    assert got == [None] * 11 + ["Nil", "na", "-", "x"]


def test_sql_functions_match_column_functions(spark):
    from linkwright.functions.sql import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([(v,) for v, _ in CLEAN], "v string")
    df.createOrReplaceTempView("names_for_sql")
    got = [r[0] for r in spark.sql("select clean_account_name(v) from names_for_sql").collect()]
    assert got == [e for _, e in CLEAN]
    r = spark.sql("select jaro_winkler_similarity('martha', 'marhta') as s").first()
    assert round(r.s, 6) == 0.961111


def test_connection_check(spark):
    from linkwright.session import connection_check
    r = connection_check(spark).first()
    assert r.version and r.database


def test_clean_account_name_parity_with_duckdb_on_unicode(spark):
    """Random Latin, Greek and Cyrillic text with combining marks: the Spark
    columns give exactly the oracle's ``clean_account_name`` macro."""
    import random

    import duckdb

    from linkwright.oracle import clean
    rnd = random.Random(3)
    ranges = [(0x20, 0x7e), (0xa0, 0x24f), (0x370, 0x3ff), (0x400, 0x4ff), (0x1e00, 0x1eff),
              (0x300, 0x36f)]
    vals = ["".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(rnd.randint(1, 12)))
            for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, v string")
    got = {r.i: r.c for r in df.select("i", clean_account_name("v").alias("c")).collect()}
    con = duckdb.connect()
    con.execute("create table t(i int, v varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(vals)))
    want = dict(con.execute(f"select i, {clean('v')} from t").fetchall())
    assert got == want


def test_casts_and_accents_equal_duckdb_everywhere(spark):
    """F10 on decimals of any length, F3 on every assigned code point of the planes with letters."""
    import random

    import duckdb

    from linkwright.functions.casts import try_cast_long
    from linkwright.functions.text import strip_accents
    rng = random.Random(1)
    values = [".5", "-.5", "5.", ".", "-.", "0.49999999999", "9223372036854775807.4", "9223372036854775807.5", "1e3", "x", ""]
    values += [rng.choice(["", "-", "+", " "]) + "".join(rng.choices("0123456789", k=rng.randint(0, 19))) + "."
               + "".join(rng.choices("0123456789", k=rng.randint(0, 30))) for _ in range(500)]
    letters = [chr(i) for i in range(0x20, 0x30000) if not 0xD800 <= i <= 0xDFFF]
    con = duckdb.connect()
    for data, expr, sql in ((values, try_cast_long("v"), "try_cast(v as bigint)"), (letters, strip_accents("v"), "strip_accents(v)")):
        con.execute("create or replace table t (i bigint, v varchar)")
        con.execute("insert into t select unnest(?), unnest(?)", [list(range(len(data))), data])
        want = con.execute(f"select {sql} from t order by i").fetchall()
        got = spark.createDataFrame(list(enumerate(data)), "i long, v string").orderBy("i").select(expr.alias("r")).collect()
        assert [r.r for r in got] == [w[0] for w in want]
