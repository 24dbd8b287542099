"""Type detection over all rows."""
from linkwright.sources.csv import cast_detected, read_typed_csv, type_counts, write_csv


def _detected(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "`a b` string").repartition(3)
    return type_counts(df).first()["detected"]


def test_lattice(spark):
    cases = {
        "boolean": [["true", "FALSE", None]],
        "bigint": [["1", "-2", " +30 ", None], ["0" * 17 + "1"]],
        "double": [["1", "2.5"], ["1e5", ".5", "-3."], ["9" * 19]],
        "date": [["2024-02-29"]],
        "timestamp": [["2024-01-01", "2024-01-01 00:00:01"], ["2024-01-01T00:00:01.5"]],
        "string": [["1", "x"], ["true", "1"], ["2024-02-30"], ["2024-01-01", "1"], [None, None], [], [""], ["1_000"], ["0x1f"],
                   ["NaN"], ["inf"], ["1d"], ["2024-1-1"]]}
    for want, columns in cases.items():
        for values in columns:
            assert _detected(spark, values) == want, (values, want)


def test_one_late_value_widens(spark):
    df = spark.range(20000).selectExpr("if(id = 19999, '1.5', cast(id as string)) as v", "cast(null as string) as n")
    found = {r["column_name"]: r for r in type_counts(df).collect()}
    assert found["v"]["detected"] == "double" and found["v"]["n_bigint"] == 19999
    assert found["n"]["n_null"] == 20000 and found["n"]["detected"] == "string"


def test_counts_are_one_aggregate(spark):
    plan = type_counts(spark.createDataFrame([("1", "2")], "a string, b string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Python" not in plan


def test_typed_read(spark, tmp_path):
    df = spark.createDataFrame([("1", "x", "2.5", None), ("2", "", "3", "2024-01-01")], "i string, s string, d string, day string")
    write_csv(df, str(tmp_path / "t.csv"))
    got = read_typed_csv(spark, str(tmp_path / "t.csv"))
    assert got.dtypes == [("i", "bigint"), ("s", "string"), ("d", "double"), ("day", "date")]
    assert cast_detected(df, {"i": "int"}).dtypes[0] == ("i", "int")
