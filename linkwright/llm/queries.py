"""The registered queries of the text operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import in_fold
from linkwright.llm.conversations import damage, repair
from linkwright.llm.decontam import find_contained
from linkwright.llm.html_text import extract
from linkwright.llm.language import LanguageModel
from linkwright.llm.minhash import near_duplicates
from linkwright.llm.oracle import ORACLE_SQL
from linkwright.llm.mixing import mix_sources
from linkwright.llm.quality_model import QualityModel
from linkwright.llm.quality_rules import judge
from linkwright.llm.secrets import find_secrets
from linkwright.llm.suffix_dedup import repeated_strings
from linkwright.llm.toxicity import ToxicityModel
from linkwright.llm.vector_codes import compress, with_label_errors
from linkwright.llm.vector_search import top_k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def predicted(score: str = "score"):
    return (F.col(score) >= 0.7).cast("int").alias("predicted")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the grammar's weights come from the two thirds of ids not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = ToxicityModel.fit(docs, labels.where(~in_fold(F.col("doc_id"), 3, 1)))
    return model.score(docs).select("doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", predicted(),
                                    F.col("best").alias("clause_weight"), F.col("total").alias("total_weight"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", F.col("text").alias("text"), F.length("text").cast("long").alias("n_chars"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the three quarters of ids not held out."""
    docs = table(spark, sf_dir, "documents")
    model = LanguageModel.fit(docs.where(~in_fold(F.col("doc_id"), 4, 2)))
    return model.label(docs).select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the three quarters of ids not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = QualityModel.fit(docs, labels.where(~in_fold(F.col("doc_id"), 4, 2)))
    return model.score(docs).select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score", predicted())


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document: counts, digest of the base spans, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id", *[F.size(of((k,))).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item it contains)."""
    return find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 50-byte strings of earlier documents."""
    found = repeated_strings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable vector, the error per label, and the digest of the codebooks."""
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_errors(codes).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of highest inner product for every row whose vec_id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation after damage."""
    rows = table(spark, sf_dir, "conversations")
    return repair(damage(rows), rows.select("conv_id")).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("digest").alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_quality_rules, op3_source_mixing, op4_html_text, op5_minhash_dedup, op6_language_id, op7_secret_scan,
                            op8_benchmark_containment, op9_suffix_dedup, op10_quality_model,
                            op11_vector_codes, op12_top_k, op13_conversation_repair)}
__all__ = ["ORACLE_SQL", "QUERIES"]
