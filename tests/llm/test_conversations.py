"""Conversation repair against plain Python, full enumeration and DuckDB SQL."""

import hashlib
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from linkwright.llm import conversations, queries
from linkwright.llm.conversations import Repairer, Rope, damage, learn_grammar, repair, rewrite
from linkwright.llm.oracle import ORACLE_SQL
from tests.llm.brute_conversations import cheapest, damaged, enumerated, faults_of, repaired

ROLES = ("system", "user", "assistant", "tool", "", None, "unit")


def symbols(rows, faults):
    return "".join("x" if f in ("blank", "duplicate") else (lambda c: c.upper() if f else c)(
        {"s": "s", "u": "u", "a": "a"}.get((r or " ")[:1], "o")) for (r, _), f in zip(rows, faults))


def random_rows(rng, n):
    return [(rng.choice(ROLES[:5]), rng.choice(["", "a.", "b", "c!", "d ", " \n", "e?\t", "f"])) for _ in range(n)]


def messy(rng):
    """(conv_id, turn, role, text) with NULLs, gaps, equal turns, copies, a long conversation and long texts."""
    rows = []
    for conv in [*range(60), None, -5]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(ROLES),
                         rng.choice([None, "", "one.", "two", "three! ", "four?", "é.", "x" * 5000 + ".", " \t", "end"])))
    for turn in range(3000):
        rows.append((999, turn, ("user", "assistant", "user")[turn % 3], f"line {turn % 1500}" + "."[: turn % 2]))
    rows += [(77, t, r, "same.") for t in (1, 2) for r in ("user", "assistant")] * 3
    return rows


def frame(spark, rows):
    """The rows with further columns whose names clash with the operator's own."""
    schema = ("conv_id long, turn long, role string, text string, conv int, key string, real string, copy string, fault string, "
              "symbol string, seq string, head string, kind string, n string, _conv long")
    return spark.createDataFrame([(*r, 1, "k", "r", "c", "f", "s", "q", "h", "t", "n", 2) for r in rows], schema).repartition(4)


def test_plain_version_equals_enumeration():
    rng = random.Random(5)
    for _ in range(120):
        rows = random_rows(rng, rng.randrange(0, 3))
        assert cheapest(rows, faults_of(rows)) == enumerated(rows, faults_of(rows))
    for _ in range(4):
        rows = random_rows(rng, 3)
        assert cheapest(rows, faults_of(rows)) == enumerated(rows, faults_of(rows))


def test_matrices_equal_plain_version_with_any_grammar():
    rng = random.Random(6)
    place = {c: i for i, c in enumerate(conversations.SYMBOLS)}
    rules = [(place["u"], place["a"]), (9, 9), (place["x"], place["u"]), (place["O"], place["O"]), (10, 10), (place["s"], 9)]
    plain, grammar = Repairer([]), Repairer(rules)
    for _ in range(400):
        rows = random_rows(rng, rng.choice([0, 1, 2, 5, 9, 40, 700]))
        faults = faults_of(rows)
        codes = np.array([place[c] for c in symbols(rows, faults)] + [-1])
        want = cheapest(rows, faults)
        assert plain.solve(codes[:-1].tolist()) == want
        assert grammar.solve(rewrite(codes, rules)[:-1].tolist()) == want


def test_rewrite_takes_runs_left_to_right():
    codes = np.array([1, 1, 1, -1, 1, 1, 1, 1, 2, -1, -1, 1, -1])
    assert rewrite(codes, [(1, 1)]).tolist() == [9, 1, -1, 9, 9, 2, -1, -1, 1, -1]
    assert rewrite(codes, [(1, 2), (1, 9)]).tolist() == [1, 1, 1, -1, 1, 1, 10, -1, -1, 1, -1]


def test_ropes_compare_like_strings():
    rng = random.Random(7)
    made = [(Rope(""), "")]
    for _ in range(300):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        t = "".join(rng.choice("DIKR") for _ in range(rng.choice([1, 1, 30])))
        made.append((a + b + Rope(t), x + y + t) if len(x) + len(y) < 3000 else (Rope(t), t))
    for _ in range(2000):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        assert str(a) == x and (a < b) == (x < y)


def test_grammar_counts_all_sequences(spark):
    rows = [("uauaua", 5), ("suaua", 2), ("", 9), ("x", 4), ("xx", 1)]
    rules = learn_grammar(spark.createDataFrame(rows, "seq string, n long").repartition(3), rounds=2, rules=1)
    assert rules == [(3, 5), (9, 9)]
    assert learn_grammar(spark.createDataFrame([], "seq string, n long")) == []


def test_repair_equals_plain_version(spark):
    rows = messy(random.Random(8))
    df = frame(spark, rows)
    got = {r["conv"]: tuple(r)[2:] for r in repair(df, df.select("conv_id")).drop("n").collect()}
    want = repaired([(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows])
    assert got == want


def test_damage_equals_plain_version(spark):
    rows = messy(random.Random(9))
    got = [tuple(r) for r in damage(frame(spark, rows)).collect()]
    key = lambda r: tuple((v is None, v or "") if not isinstance(v, int) else (False, str(v)) for v in r)
    assert sorted(got, key=key) == sorted(damaged(rows), key=key)


def test_empty_table_and_ids_without_rows(spark):
    df = frame(spark, [])
    assert repair(df, df.select("conv_id")).count() == 0
    got = repair(df, spark.createDataFrame([(1,), (1,), (None,)], "x long")).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted((r["conv"] or 0, r["gaps"], r["illegal"], r["cost"], r["audit"], r["digest"]) for r in got) == [
        (0, 0, 0, 0, "", nothing), (1, 0, 0, 0, "", nothing)]


def test_text_ids(spark):
    df = spark.createDataFrame([("a", 1, "user", "x."), ("a", 2, "assistant", "y."), ("b", 1, "user", "x.")],
                               "conv_id string, turn long, role string, text string")
    assert {r["conv"]: r["audit"] for r in repair(df).collect()} == {"a": "KK", "b": "KI"}


def test_query_equals_sql_and_plain_version(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf_dir}/conversations.parquet')")
    want = con.execute(ORACLE_SQL["op13_conversation_repair"])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES["op13_conversation_repair"](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert rows == sorted(want.fetchall())
    source = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    plain = repaired(damaged(source))
    assert all(tuple(r)[1:] == plain[r["conv_id"]] for r in got.collect() if r["conv_id"] in plain)
    assert got.where(F.col("conv_id").isNull()).count() == 0
