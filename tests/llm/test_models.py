"""Held-out accuracy of the fitted models, and their answers at the edges."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkwright.llm import language, quality_model, queries
from linkwright.llm.language import LanguageModel
from linkwright.llm.quality_model import QualityModel
from linkwright.llm.toxicity import Grammar, ToxicityModel

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth():
    rows = duckdb.sql(f"select d.doc_id, lang, quality, toxic from '{SF}/documents.parquet' d "
                      f"left join '{SF}/labels.parquet' using (doc_id)").fetchall()
    return {r[0]: r[1:] for r in rows}


def held_out(df, answer, truth, which):
    rows = [(r[answer], truth[r.doc_id][which]) for r in df.collect() if r.held_out]
    return [r for r in rows if r[1] is not None]


def test_language_accuracy(spark, truth):
    got = held_out(queries.op6_language_id(spark, SF), "lang_pred", truth, 0)
    assert len(got) > 150 and sum(a == b for a, b in got) >= 0.97 * len(got)


def test_rare_languages_are_learnt_too(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 4)
    rows = [(100 * k + i, " ".join(chr(97 + 2 * k) * (1 + (i + j) % 4) + chr(98 + 2 * k) for j in range(12)), f"l{k:02}")
            for k in range(12) for i in range(20 - k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = LanguageModel.fit(docs, rows_per_language=6, landmarks=4)
    assert model.languages == sorted({r[2] for r in rows}) and len(model.landmarks) >= 12
    assert {r.doc_id: r.lang_pred for r in model.label(docs).collect()} == {r[0]: r[2] for r in rows}


def test_quality_accuracy(spark, truth):
    df = queries.op10_quality_model(spark, SF)
    got = held_out(df, "predicted", truth, 1)
    assert sum(a == b for a, b in got) >= 0.9 * len(got)
    assert df.where("score < 0 or score > 1 or score is null").isEmpty()


def test_toxicity_accuracy(spark, truth):
    got = held_out(queries.op1_toxicity(spark, SF), "predicted", truth, 2)
    assert sum(a == b for a, b in got) >= 0.93 * len(got)
    assert sum(a for a, b in got if b == 0) <= 2


def test_grammar_composes_clauses():
    g = Grammar({"moron": 3.0}, {"idio": 2.0}, {"kill": 2.0})
    arcs = g.automaton()
    plain, addressed = g.clause("a moron walks"), g.clause("you moron")
    assert 0 < plain < addressed
    assert g.clause("you are not a moron") < addressed
    assert g.clause("she said you moron") < addressed
    assert g.clause('the word "moron" appears') < plain
    assert g.clause("kill the lights") == 0 and g.clause("i will kill you") > 0
    assert g.clause("idiotic") == 2.0
    best, total, _ = g.read("One moron. Fine here. You moron!", arcs)
    assert best == addressed and total == pytest.approx(plain + addressed)
    assert g.read("oxymoron", arcs)[0] == 0 and g.read(None, arcs) == (0.0, 0.0, 0.0)


def test_models_answer_every_row(spark, messy, messy_rows, empty):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(30)], "doc_id long, quality int, t boolean")
    labels = labels.withColumn("toxic", F.col("t").cast("int"))
    nothing = labels.limit(0)
    for fitted in (QualityModel.fit(messy, labels), QualityModel.fit(messy, nothing), QualityModel.fit(empty, labels),
                   ToxicityModel.fit(messy, labels), ToxicityModel.fit(messy, nothing)):
        rows = fitted.score(messy).collect()
        assert len(rows) == len(messy_rows) and all(0 <= r.score <= 1 for r in rows)
        assert fitted.score(empty).collect() == []
    for model in (LanguageModel.fit(messy), LanguageModel.fit(empty)):
        rows = model.label(messy).collect()
        assert len(rows) == len(messy_rows) and all(0 <= r.score <= 1 for r in rows)
        by = {r.doc_id: r.lang_pred for r in rows}
        assert by[500] == by[501] == by[502] == "und"
        assert model.label(empty).collect() == []


def test_word_vectors_come_from_unlabelled_texts_too(spark):
    labelled = [(i, " ".join(f"w{(i * j) % 31}" for j in range(1, 30)) + " rare" * (i == 3)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    more = [(100 + i, f"rare alpha{i % 3} beta rare gamma") for i in range(9)]
    schema = "doc_id long, text string"
    few, all_ = spark.createDataFrame(labelled, schema), spark.createDataFrame(labelled + more, schema)
    read = spark.createDataFrame([(1, "rare beta gamma rare alpha1")], schema)
    assert QualityModel.fit(few, labels).score(read).first().score != QualityModel.fit(all_, labels).score(read).first().score


def test_word_vectors_equal_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "HELD", 50)
    texts = [" ".join(f"w{(i * j * j) % 83}" for j in range(1, 40)) + f" only{i} x only{i}" for i in range(1, 30)] + ["", None, "w1"]
    vectors, powers = quality_model.index_table(), quality_model.Powers()
    forms, sums = [], {}
    for t in texts:
        words = quality_model.Words(*next(quality_model.blocks(pa.array([t], pa.string())))[2:])
        form = words.hashes(powers, lower=False)
        index = [a + b for a, b in zip(quality_model.index_vectors(form, vectors),
                                       quality_model.index_vectors(quality_model.shape_hashes(words, powers), vectors))]
        for i, f in enumerate(form.tolist()):
            sums[f] = sums.get(f, 0) + sum((index[j] for j in range(max(0, i - 2), min(len(form), i + 3)) if j != i), np.zeros(64))
        forms.append(set(form.tolist()))
    shared = sorted(f for f in sums if sum(f in d for d in forms) > 1)
    keys, got = quality_model.gather_contexts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    assert keys.tolist() == shared and len(shared) < len(sums)
    assert np.abs(got / 127 - quality_model.unit(np.array([sums[f] for f in shared]))).max() < 0.005
    # a form of one document: the same vector, made from that document
    column = pa.array(texts, pa.string())
    everything = np.array(sorted(sums), dtype=np.uint64)
    full = (everything, 127 * quality_model.unit(np.array([sums[f] for f in sorted(sums)])))
    assert np.abs(quality_model.pool(column, (keys, got), powers) - quality_model.pool(column, full, powers)).max() < 0.01


def test_folded_sums_come_back():
    rng = np.random.default_rng(2)
    for n, kind in ((0, np.int8), (1, np.int64), (5000, np.int8), (3000, np.int64)):
        keys = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        docs, sums = rng.integers(1, 9, n), rng.integers(-100, 100, (n, 64)).astype(kind)
        back = quality_model.unfolded(quality_model.folded(keys, docs, sums))
        order = np.argsort(keys, kind="stable")
        assert all((a == b[order]).all() and a.dtype == b.dtype for a, b in zip(back, (keys, docs, sums)))
