"""The candidate-key join equals the nested-loop definition."""
import random

import pytest

from linkwright import derived
from linkwright.functions.similarity import jaro_winkler
from linkwright.operators.fuzzy_join import KEY_TOKENS, group_limits, jaro_winkler_join, level_budgets
from conftest import SF_MID, SF_SMALL


def _mutations(names, seed, n_each=3):
    rnd = random.Random(seed)
    out = []
    for s in names:
        for _ in range(n_each):
            b = list(s)
            for _ in range(rnd.randint(0, 2)):
                op = rnd.random()
                if op < 0.3 and b:
                    b.pop(rnd.randrange(len(b)))
                elif op < 0.6:
                    b.insert(rnd.randint(0, len(b)), rnd.choice("aeiounrst0"))
                elif len(b) > 1:
                    i = rnd.randrange(len(b) - 1)
                    b[i], b[i + 1] = b[i + 1], b[i]
            out.append("".join(b))
    return out


def _brute(left, right, threshold):
    out = set()
    for a in set(left):
        for b in set(right):
            if a is None or b is None:
                continue
            s = jaro_winkler(a, b)
            if a == b or s > threshold:
                out.add((a, b, round(s, 9)))
    return out


@pytest.mark.parametrize("threshold", [0.95, 0.9, 0.85])
def test_equals_brute_force(spark, threshold):
    base = ["mullersohne", "acmeindustries", "berlinerbank", "ab", "a", "", "zz",
            "schmidtundpartner", "hauptbahnhof", "nordlicht", "x1", "abcd", "abdc",
            "qqqqqqqqqqqqqqqqqqqq", "marhta", "martha", "dwayne", "duane",
            # around the long-name boundary of level-0 key families (35-48)
            "niederlassungnordverwaltungsgesellsch", "niederlassungnordverwaltungsgesellschaft",
            "stadtwerkeniederlassungnordverwaltungsgesellschaft",
            "abcdefghijklmnopqrstuvwxyz0123456789ab", "bacdefghijklmnopqrstuvwxyz0123456789abcdef"]
    left = base + _mutations(base, 1)
    right = base[::2] + _mutations(base, 2) + [None]
    got = jaro_winkler_join(spark.createDataFrame([(x,) for x in left], "n string"),
                            spark.createDataFrame([(x,) for x in right], "n string"),
                            threshold).collect()
    got = {(r["a"], r["b"], round(r["sim"], 9)) for r in got}
    assert got == _brute(left, right, threshold)


def test_titles_equal_brute_force(spark):
    """Real near copies: cleaned document titles, all pairs checked."""
    from linkwright.functions.text import clean_account_name
    from pyspark.sql import functions as F
    t = derived.titles(spark, SF_SMALL).select(clean_account_name("title").alias("n"))
    names = [r["n"] for r in t.collect()]
    left, right = names[::2], names[1::2] + _mutations(names[:40], 3)
    got = jaro_winkler_join(spark.createDataFrame([(x,) for x in left], "n string"),
                            spark.createDataFrame([(x,) for x in right], "n string")).collect()
    assert {(r["a"], r["b"], round(r["sim"], 9)) for r in got} == _brute(left, right, 0.95)


def test_group_limits():
    """Every group budget leaves an entry of KEY_TOKENS for each difference of sizes."""
    assert [round(b, 4) for b in level_budgets(0.95)] == [0.15, 0.1667, 0.1875, 0.2143, 0.25]
    assert group_limits(0.15, 8) == (1, 1) and group_limits(0.15, 60) == (3, 3) and group_limits(0.25, 60) == (4, 3)
    for threshold in (0.7, 0.75, 0.85, 0.9, 0.95, 0.99):
        for budget in level_budgets(threshold):
            assert all(0 <= group_limits(budget, top)[1] < len(KEY_TOKENS) for top in range(8, 3000))


def test_plan_has_no_nested_loop(spark):
    a = spark.createDataFrame([("abc",)], "n string")
    plan = jaro_winkler_join(a, a)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("threshold,alphabet,seed", [
    (0.95, "abc", 5), (0.9, "abc", 6), (0.85, "abcd", 7), (0.75, "ab", 8), (0.95, "ab", 9),
    (0.9, "aéßü😀", 10)])
def test_random_small_alphabet_equals_brute_force(spark, threshold, alphabet, seed):
    """Small alphabets and short names put many pairs right at the bounds."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14))) for _ in range(120)]
    left = base[:60] + _mutations(base[:30], seed)
    right = base[60:] + _mutations(base[30:60], seed + 100)
    got = jaro_winkler_join(spark.createDataFrame([(x,) for x in left], "n string"),
                            spark.createDataFrame([(x,) for x in right], "n string"),
                            threshold).collect()
    assert {(r["a"], r["b"], round(r["sim"], 9)) for r in got} == _brute(left, right, threshold)


def test_threshold_is_strict(spark):
    """§2.13 item 13: a score of exactly 0.95 does not match; 0.95 plus one ulp does."""
    left = spark.createDataFrame([("cdcdbdbb",), ("abcdefghijklmnopqrst",)], "n string")
    right = spark.createDataFrame([("cdcdbdba",), ("badcfeghijklmnopqrst",)], "n string")
    got = {(r["a"], r["b"]) for r in jaro_winkler_join(left, right).collect()}
    assert jaro_winkler("cdcdbdbb", "cdcdbdba") == 0.95
    assert got == {("abcdefghijklmnopqrst", "badcfeghijklmnopqrst")}


@pytest.mark.parametrize("alphabet,lengths", [("abcdefghijklmnopqrstuvwxyz0123456789", (120, 300)), ("0123456789", (20, 90)),
                                              ("абвгдежзийклмнопрстуфхцчшщъыьэюя", (40, 160))])
def test_names_around_the_limit_of_short_keys_equal_brute_force(spark, alphabet, lengths):
    rnd = random.Random(len(alphabet))
    base = ["".join(rnd.choices(alphabet, range(1, len(alphabet) + 1), k=rnd.randint(*lengths))) for _ in range(40)]
    cut = [s[:len(s) - rnd.randint(1, len(s) // 6)] for s in base]      # on either side of the limit
    left, right = base + _mutations(cut, 1, 1), cut + _mutations(base, 2, 2)
    got = jaro_winkler_join(spark.createDataFrame([(x,) for x in left], "n string"),
                            spark.createDataFrame([(x,) for x in right], "n string")).collect()
    assert {(r["a"], r["b"], round(r["sim"], 9)) for r in got} == _brute(left, right, 0.95)


def test_candidates_are_few(spark, tmp_path):
    """What the scorer gets does not grow with all pairs: the share that meets, and the key rows of a name."""
    from linkwright.functions.text import clean_account_name
    from linkwright.operators.fuzzy_join import name_keys
    from linkwright.plans.incremental import LinkStore
    names = derived.titles(spark, SF_MID).select(clean_account_name("title").alias("name")).where("name <> ''").distinct()
    n = names.count()
    store = LinkStore(spark, str(tmp_path / "store"))
    store.add_accounts(derived.accounts(spark, SF_MID))
    order = spark.read.parquet(f"{store.base}/order")
    keys = name_keys(names, order, store.threshold, True).withColumnRenamed("id", "a_id")
    assert keys.count() < 1000 * n and store.keys(1).count() < 200 * store.names(1).count()
    met = store.candidates(keys, 1).select("a_id", "b_id").where("a_id <> b_id").distinct().count()
    assert met < 0.01 * n * store.names(1).count()


@pytest.mark.parametrize("query", ["link_waterfall", "link_incremental", "match_summary", "ensure_all_keys", "address_match"])
def test_queries_score_few_pairs(spark, monkeypatch, query):
    """The scorer of the query's name matches gets less than a hundredth of all pairs."""
    from linkwright import workloads
    from linkwright.operators import fuzzy_join
    from linkwright.plans import incremental
    shares, score = [], fuzzy_join.scored_pairs

    def counted(candidates, a_names, b_names, threshold):
        pairs = a_names.distinct().count() * b_names.distinct().count()
        if pairs > 3_000:
            shares.append(candidates.select("a_id", "b_id").where("a_id <> b_id").distinct().count() / pairs)
        return score(candidates, a_names, b_names, threshold)

    for module in (fuzzy_join, incremental):
        monkeypatch.setattr(module, "scored_pairs", counted)
    workloads.QUERIES[query](spark, SF_MID).count()
    assert shares and max(shares) < 0.01
