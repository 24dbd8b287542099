"""The trained address parser: Viterbi against all label paths, training, use in the address matcher."""
import itertools

import numpy as np
import pytest

from conftest import SF_SMALL
from linkwright import derived
from linkwright.functions.address_model import DIMENSION, LABELS, AddressModel, fit, token_features, tokens_of
from linkwright.plans.matchers import match_by_address


@pytest.fixture(scope="module")
def model(spark):
    return fit(derived.labelled_addresses(spark, SF_SMALL).where("k % 5 <> 0"))


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    size = len(LABELS)
    for line in ["", "a", "Hauptstr. 5", "12345 Ulm,", "Am Markt 5 a", "x , , 7"]:
        # whole numbers: sums are exact and ties occur
        model = AddressModel(rng.integers(-2, 3, (DIMENSION, size)).astype(float), rng.integers(-2, 3, (size + 1, size)).astype(float))
        tokens = tokens_of(line)
        feats = token_features(tokens)

        def score(path):
            return sum(model.weights[feats[i], c].sum() + model.steps[path[i - 1] if i else -1, c] for i, c in enumerate(path))

        best = max(score(p) for p in itertools.product(range(size), repeat=len(tokens)))
        assert score(model.path(tokens)) == best


def test_held_out_lines(spark, model):
    """Lines of pages that training did not read, in all four orders."""
    rows = derived.labelled_addresses(spark, SF_SMALL).where("k % 5 = 0").collect()
    assert len(rows) >= 5
    for r in rows:
        assert tokens_of(r["line"]) == r["tokens"]
        assert [LABELS[c] for c in model.path(r["tokens"])] == r["labels"], r["line"]


def test_training_is_repeatable_and_reads_all_tasks(spark, model):
    lines = derived.labelled_addresses(spark, SF_SMALL).where("k % 5 <> 0")
    again = fit(lines.repartition(7))
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.steps, model.steps)
    nothing = fit(lines.where("false"))
    assert not nothing.weights.any() and nothing.parse("Hauptstr. 5")["house_number"] is None


def test_parts_of_odd_lines(spark, model):
    df = spark.createDataFrame([(None,), ("",), (" , ",), ("Müllerweg 5a, 12345, Deutschland",), ("x" * 5000,)], "line string")
    got = [r["p"] for r in df.select(model.parser()("line").alias("p")).collect()]
    assert tuple(got[0]) == tuple(got[1]) == (None, None, None, None)
    assert tuple(got[3]) == ("müllerweg", "5a", "12345", None)


def test_matcher_takes_the_trained_parser(spark, model):
    firms, accounts = derived.firms(spark, SF_SMALL), derived.accounts(spark, SF_SMALL)
    by_rules = match_by_address(firms, accounts).select("rec_id", "Id").collect()
    by_model = match_by_address(firms, accounts, parser=model.parser()).select("rec_id", "Id").collect()
    assert by_rules and sorted(map(tuple, by_model)) == sorted(map(tuple, by_rules))
