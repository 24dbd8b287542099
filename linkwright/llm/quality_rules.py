"""Quality rules: counts per document, then robust multivariate outliers, in DataFrame operations only.

Base rules fail documents of very few words or of much repetition. The others are held against
the documents of their language and source: their statistics, transformed to be comparable
between short and long texts, form a vector, and a document goes if its Mahalanobis distance
under the group's minimum-covariance-determinant estimate is too large.

The estimate starts from medians and median absolute deviations and improves in concentration steps:
take the ``CORE`` share of the group nearest by the present estimate, then estimate mean and
covariance from those. Start and core both hold with junk in up to half of a group. Every step is one grouped aggregation of sums (combined before the
shuffle), so a group of any size costs the same per row and none is gathered. Vectors are whole
numbers (thousandths): sums are exact, and reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import stage

WHITE = r"[\x20\x09-\x0D]+"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WORDS = 10, 20, 5
#: Share of a group that the estimate is drawn from, and concentration steps.
CORE, STEPS = 0.5, 3
#: Least standard deviation of each component (thousandths), so that a component which hardly
#: varies in a group cannot reject small differences.
FLOOR = (250.0, 100.0, 30.0, 40.0)
#: Squared distance from which a document goes; a normal vector of four reaches it 4 times in 100 million.
CUTOFF = 40.0
#: Median of the chi-square distribution with four degrees of freedom (fixed value).
CHI2_MEDIAN = 3.3567
#: Distances are ranked in hundredths up to this one.
FAR = 1_000_000
X = ("x0", "x1", "x2", "x3")
PAIRS = tuple((i, j) for i in range(4) for j in range(i, 4))


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_upper of a text column."""
    d = docs.withColumn("_words", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), WHITE), ""))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    k = REPEAT_WORDS
    # hashes of the k-word windows, in text order
    d = d.withColumn("_win", F.when(F.col("n_words") >= k, F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - k).cast("int")),
        lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>")))
    # only texts in which a window repeats go through sorting
    d = d.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    d = d.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", lambda e, i: (
        F.coalesce(F.get("_sorted", i - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get("_sorted", i + 1)["h"] == e["h"], F.lit(False)))), lambda e: e["i"])))
    covered = F.transform("_at", lambda p, i: F.coalesce(F.least(F.lit(k), F.get("_at", i + 1) - p), F.lit(k)))
    lines = F.filter(F.split(F.col(text), "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("_lines", F.coalesce(lines, F.array().cast("array<string>")))

    def count(pattern: str) -> Column:
        return F.coalesce(F.length(F.regexp_replace(text, pattern, "")), F.lit(0)).cast("long")

    return (d.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long"))
            .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
            .withColumn("n_symbols", count(r"[^#*$%&|<>]+"))
            .withColumn("n_upper", count(r"[^A-Z]+"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .drop("_words", "_win", "_sorted", "_at", "_lines"))


def vectors(rows: DataFrame) -> DataFrame:
    """Transformed statistics x0..x3 in thousandths; ``mean_len`` is the group's mean word length.

    Deviation of the mean word length, log density of symbols, share of capitals and share of
    repeated words, each drawn towards the group's usual value for short texts.
    """
    n, chars = F.col("n_words"), F.col("word_chars")
    return (rows.withColumn("x0", F.round(1000 * (chars - F.col("mean_len") * n) / (n + 100)).cast("long"))
            .withColumn("x1", F.round(1000 * F.log(1 + 20.0 * F.col("n_symbols") / (chars + 100))).cast("long"))
            .withColumn("x2", F.round(1000 * F.col("n_upper") / (chars + 100)).cast("long"))
            .withColumn("x3", F.round(1000 * F.col("n_repeat_words") / (n + 20)).cast("long")))


def total(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def with_triangle(sums: DataFrame) -> DataFrame:
    """Centre _m0.., and unit lower triangle _l.. and diagonal _d.. of the covariance's L D L' decomposition,
    from the count _n, sums _s0.. and sums of products _p00.. of a group.

    Built column by column, so that no expression repeats another one.
    """
    out = sums.withColumns({f"_m{i}": F.col(f"_s{i}") / F.col("_n") for i in range(4)})
    out = out.withColumns({f"_c{i}{j}": (F.col(f"_p{i}{j}") / F.col("_n") - F.col(f"_m{i}") * F.col(f"_m{j}"))
                           + (FLOOR[i] * FLOOR[i] if i == j else 0.0) for i, j in PAIRS})
    for j in range(4):
        less = [F.col(f"_l{j}{k}") * F.col(f"_l{j}{k}") * F.col(f"_d{k}") for k in range(j)]
        out = out.withColumn(f"_d{j}", reduce(lambda a, b: a - b, [F.col(f"_c{j}{j}"), *less]))
        rows = {}
        for i in range(j + 1, 4):
            less = [F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") * F.col(f"_d{k}") for k in range(j)]
            rows[f"_l{i}{j}"] = reduce(lambda a, b: a - b, [F.col(f"_c{j}{i}"), *less]) / F.col(f"_d{j}")
        if rows:
            out = out.withColumns(rows)
    return out.drop(*[f"_c{i}{j}" for i, j in PAIRS], *[f"_p{i}{j}" for i, j in PAIRS], *[f"_s{i}" for i in range(4)], "_n")


def with_distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``distance2`` of x0..x3 from the joined estimate, by forward substitution."""
    for i in range(4):
        less = [F.col(f"_l{i}{k}") * F.col(f"_y{k}") for k in range(i)]
        rows = rows.withColumn(f"_y{i}", reduce(lambda a, b: a - b, [F.col(X[i]) - F.col(f"_m{i}"), *less]))
    return rows.withColumn("distance2", total([F.col(f"_y{i}") * F.col(f"_y{i}") / F.col(f"_d{i}") for i in range(4)]))


def match(keys: list[str]) -> Column:
    """Rows and estimates of one group: key columns equal, NULL being a value."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])


def estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Estimate per group of ``rows`` (key columns and x0..x3): its keys as _k0.., centre _m0.., the
    triangle and diagonal of its covariance _l.., _d.., and the factor that makes the distances consistent."""
    k = [f"_k{i}" for i in range(len(keys))]
    named, same = [F.col(c).alias(n) for c, n in zip(keys, k)], match(keys)

    def grouped(frame: DataFrame, *aggregates: Column) -> DataFrame:
        return stage(frame.groupBy(*named).agg(*aggregates), "quality-group")

    def ranked(d2: Column) -> Column:
        return F.least(F.round(100 * d2), F.lit(float(FAR))).cast("long")

    middles = grouped(rows, *[F.percentile(x, F.lit(0.5)).alias(f"{x}_mid") for x in X])
    start = grouped(rows.join(middles, same), *[F.max(f"{x}_mid").alias(f"{x}_mid") for x in X],
                    *[F.percentile(F.abs(F.col(x) - F.col(f"{x}_mid")), F.lit(0.5)).alias(f"{x}_mad") for x in X])
    near = total([((F.col(x) - F.col(f"{x}_mid")) * (F.col(x) - F.col(f"{x}_mid")))
                  / F.greatest(F.lit(f * f), F.pow(1.4826 * F.col(f"{x}_mad"), F.lit(2.0)))
                  for x, f in zip(X, FLOOR)])
    measured = rows.join(start, same).select(*rows.columns, near.alias("distance2"))
    for _ in range(STEPS):
        cut = grouped(measured, F.percentile(ranked(F.col("distance2")), F.lit(CORE)).alias("_cut"))
        core = measured.join(cut, same).where(ranked(F.col("distance2")) <= F.col("_cut"))
        sums = grouped(core, F.count(F.lit(1)).alias("_n"), *[F.sum(x).alias(f"_s{i}") for i, x in enumerate(X)],
                       *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"_p{i}{j}") for i, j in PAIRS])
        estimate = stage(with_triangle(sums), "quality-estimate")
        measured = with_distance(rows.join(estimate, same)).select(*rows.columns, "distance2")
    # consistency: the core's covariance is too small; never make it smaller
    middle = measured.groupBy(*[F.col(c).alias(f"{n}m") for c, n in zip(keys, k)]).agg(
        F.percentile(ranked(F.col("distance2")), F.lit(0.5)).alias("_mid"))
    own = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}m")) for n in k])
    return (estimate.join(middle, own).withColumn("_factor", F.greatest(F.lit(1.0), F.col("_mid") / 100 / CHI2_MEDIAN))
            .drop("_mid", *[f"{n}m" for n in k]))


class QualityRules:
    """Estimates of all groups of a corpus: one small row per language and source."""

    KEYS = ["_lang", "_source"]

    def __init__(self, groups: DataFrame) -> None:
        self.groups = groups

    @classmethod
    def fit(cls, counts: DataFrame) -> QualityRules:
        """``counts`` are :func:`base_counts` of the corpus; documents failing the base rules take no part."""
        good = counts.where(~F.col("base_failed"))
        means = stage(good.groupBy(F.col("_lang").alias("_k0"), F.col("_source").alias("_k1"))
                      .agg((F.sum("word_chars") / F.sum("n_words")).alias("mean_len")), "quality-means")
        rows = stage(vectors(good.join(means, match(cls.KEYS))).select(*cls.KEYS, *X), "quality-vectors")
        found = estimates(rows, cls.KEYS)
        means = means.select(F.col("_k0").alias("_g0"), F.col("_k1").alias("_g1"), "mean_len")
        own = F.col("_k0").eqNullSafe(F.col("_g0")) & F.col("_k1").eqNullSafe(F.col("_g1"))
        return cls(stage(found.join(means, own).drop("_g0", "_g1"), "quality-model"))

    def apply(self, counts: DataFrame) -> DataFrame:
        """Add ``kept`` and ``distance2`` (NULL where the base rules fail) to rows with counts."""
        rows = with_distance(vectors(counts.join(self.groups, match(self.KEYS), "left")))
        d2 = F.when(~F.col("base_failed"), F.col("distance2") / F.col("_factor"))
        return rows.withColumn("distance2", d2).withColumn(
            "kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") < CUTOFF, F.lit(True)))


def base_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``docs`` with counts, base verdict, and the group columns _lang and _source."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (with_counts(docs.withColumns({"_lang": F.col(lang_col).cast("string"),
                                          "_source": F.col(source_col).cast("string"),
                                          "_text": F.col(text_col).cast("string")}), "_text")
            .withColumn("base_failed", failed).drop("_text"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """Counts and verdict per document: ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance2)``, one row per input row.

    A NULL text counts as empty and fails; a NULL language or source is a group of its own;
    repeated rows are judged each. Documents failing the base rules have no distance and no part
    in the estimates. A group of one document is its own centre and keeps it. An empty table
    gives an empty result.
    """
    counts = stage(_counted(docs, id_col, text_col, lang_col, source_col), "quality-counts")
    return QualityRules.fit(counts).apply(counts).select("doc_id", *COUNTS, "base_failed", "kept", "distance2")


def _counted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    few = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_a"),
                      F.col(source_col).alias("_b"))
    return base_counts(few, "_t", "_a", "_b").drop("_t", "_a", "_b")


def keep_good(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """``docs`` without the documents that the rules reject; columns as they were.

    Each row is judged by its own text, language and source; rows that repeat an id need not agree.
    """
    row = F.xxhash64(*[F.col(c).cast("string") for c in (id_col, lang_col, source_col, text_col)])
    counts = stage(_counted(docs.withColumn("_row", row), "_row", text_col, lang_col, source_col), "quality-counts")
    kept = QualityRules.fit(counts).apply(counts).where("kept").select("doc_id").distinct()
    return docs.join(kept.select(F.col("doc_id").alias("_kept")), row == F.col("_kept"), "left_semi")
