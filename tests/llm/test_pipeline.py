"""The pipeline's stages against plain Python, each on its own input."""

import hashlib

import corpus_pipeline
from linkwright.llm.quality_rules import judge
from linkwright.llm.secrets import scanner
from tests.llm.test_minhash import brute, shingles


def test_stages_and_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "source_mixing"]
    rows = {n: None for n in names}
    for name, apply in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after_df = apply(spark, docs, sf_dir)
        after = {r.doc_id: r for r in after_df.collect()}
        if name != names[-1]:
            assert after_df.columns == docs.columns
        rows[name] = len(after)
        if name == "quality_rules":
            assert set(after) == {r.doc_id for r in judge(docs).where("kept").collect()}
        elif name == "minhash_near_dedup":
            group = brute([(d, r.text) for d, r in before.items()])
            assert set(after) == {d for d in before if group[d] == d}
        elif name == "benchmark_decontamination":
            clean = {d for d, r in before.items()
                     if not any(100 * len(i & shingles(r.text)) >= 75 * len(i) for i in items)}
            assert set(after) == clean
        elif name == "secret_scan":
            scan = scanner()
            assert set(after) == set(before)
            for d, r in before.items():
                assert (after[d].text == r.text) == (not scan(r.text))
                assert after[d].n_chars == len(after[d].text)
        else:
            assert set(after) <= set(before) and all(r.taken > 0 for r in after.values())
        if name != names[-1]:
            docs = spark.createDataFrame(list(after.values()), docs.schema)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert hashlib.md5(str(sorted(map(tuple, whole.collect()))).encode()).hexdigest() == hashlib.md5(
        str(sorted(tuple(r) for r in after.values())).encode()).hexdigest()
