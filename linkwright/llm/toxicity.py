"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers read the words of a clause, and their outputs are composed:

* **insult**: words or stems, each with the weight (log-odds) learnt for it from labels;
* **threat**: verbs of harm; counted only in a clause with a target, unless labels say otherwise;
* **target**: persons addressed or spoken of; an insult or threat near one weighs more;
* **negation**: a negated insult or threat (negator up to two words before) weighs less;
* **reported speech**: after a verb of saying or inside quotes, what follows weighs less.

A clause ends at ``. ! ? ; :`` or a line end. Isolated words are not scored: the weight of a
clause is that of its best composed path, and a text is scored by its heaviest clause and the
sum of all, also in relation to its length, calibrated by a logistic curve on the labels.

An Aho-Corasick automaton finds the clauses that hold an insult or threat at all; only
those are read, so the whole of every text is covered at the cost of one scan.

Only text is an input of a score. The grammar's own word lists are short and common; words
and stems of insult come from the labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import share, stage

#: Labelled rows used for fitting, and arcs of the insult transducer, at most.
SAMPLE_ROWS, MAX_ARCS = 20_000, 5_000
#: A word or stem is an arc if its log-odds reach this floor, and chance alone would make
#: fewer than one word in e^SURE of the vocabulary look as toxic (Chernoff bound).
MIN_LOG_ODDS, SURE = 2.0, 1.0
#: A stem needs this many different words and this many letters at least.
STEM_WORDS, STEM_LETTERS, STEM_LONGEST = 4, 3, 8

# fixed values: the closed word classes of the grammar (English, German, French, Spanish)
THREATS = ("kill", "hurt", "destroy", "beat", "stab", "shoot", "töten", "umbringen", "verletzen", "schlagen",
           "tuer", "frapper", "blesser", "matar", "golpear", "herir")
TARGETS = frozenset((
    "you", "your", "yours", "u", "he", "she", "they", "them", "him", "her", "people", "du", "dich", "dir", "ihr",
    "euch", "sie", "tu", "toi", "te", "vous", "ils", "elles", "lui", "eux", "tú", "ti", "usted", "ustedes", "vosotros",
    "él", "ella", "ellos"))
NEGATORS = frozenset(("not", "no", "never", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "non",
                      "don't", "isn't", "aren't", "won't"))
REPORTERS = frozenset(("said", "says", "called", "quoted", "wrote", "reported", "claimed", "sagte", "schrieb", "nannte",
                       "dit", "déclaré", "écrit", "dijo", "escribió", "llamó"))
QUOTES = "\"“”„«»"
THREAT_WEIGHT, TARGET_GAIN, NEGATION_GAIN, REPORT_GAIN, NEAR = 2.0, 1.25, 0.6, 0.7, 3

CLAUSE_END = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[\"“”„«»]")
WORD_SPLIT = r"[^\p{L}']+"


class Grammar:
    """The composed transducers. ``words`` and ``stems`` map an insult to its weight."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], threats: dict[str, float]) -> None:
        self.words, self.stems, self.threats = words, stems, threats
        self.lengths = sorted({len(s) for s in stems})
        self.curve = (-3.0, 0.5, 0.5, 0.5)

    def automaton(self):
        import ahocorasick

        arcs = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *self.threats}:
            arcs.add_word(w, len(w))
        if len(arcs):
            arcs.make_automaton()
        return arcs

    def insult(self, word: str) -> float:
        weight = self.words.get(word, 0.0)
        for n in self.lengths:
            if n > len(word):
                break
            weight = max(weight, self.stems.get(word[:n], 0.0))
        return weight

    def clause(self, text: str) -> float:
        """Weight of one lower-cased clause."""
        tokens = TOKEN.findall(text)
        targets = [i for i, t in enumerate(tokens) if t in TARGETS]
        total, negated, reported, quoted = 0.0, -9, False, False
        for i, token in enumerate(tokens):
            if token in QUOTES:
                quoted = not quoted
                continue
            if token in NEGATORS:
                negated = i
            weight = self.insult(token)
            if not weight and targets:
                weight = self.threats.get(token, 0.0)
            if weight:
                if any(abs(i - t) <= NEAR for t in targets):
                    weight *= TARGET_GAIN
                if i - negated <= 2:
                    weight *= NEGATION_GAIN
                if reported or quoted:
                    weight *= REPORT_GAIN
                total += weight
            if token in REPORTERS:
                reported = True
        return total

    def read(self, text: str | None, arcs) -> tuple[float, float, float]:
        """Heaviest clause, sum of all clauses, and sum per thousand characters of a text."""
        if not text or not len(arcs):
            return 0.0, 0.0, 0.0
        lowered = text.lower()
        best = total = 0.0
        done = 0
        for end, size in arcs.iter(lowered):
            start = end - size + 1
            if start < done or (start and lowered[start - 1].isalpha()):
                continue
            a = max((m.end() for m in _ends_before(lowered, done, start)), default=done)
            m = CLAUSE_END.search(lowered, end + 1)
            done = m.end() if m else len(lowered)
            weight = self.clause(lowered[a:m.start() if m else done])
            best, total = max(best, weight), total + weight
        return best, total, 1000.0 * total / (len(text) + 500)


def _ends_before(text: str, lo: int, hi: int):
    """The last clause end between two positions, if any."""
    at = max(text.rfind(c, lo, hi) for c in ".!?;:\n")
    if at >= 0:
        yield CLAUSE_END.match(text, at)


def learn_arcs(texts: DataFrame) -> tuple[dict[str, float], dict[str, float], dict[str, float]]:
    """Weights of words, stems and threats from ``texts`` (text, label): log-odds of the texts that hold them."""
    words = texts.select("label", F.explode(F.array_distinct(F.split(F.lower("text"), WORD_SPLIT))).alias("word"))
    counts = stage(words.where("length(word) >= 2").groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")), "toxicity-words")
    both = texts.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    n_toxic, n_clean = int(both[0] or 0), int(both[1] or 0)
    if not n_toxic or not n_clean:
        return {}, {}, {t: THREAT_WEIGHT for t in THREATS}

    def odds(toxic, clean):
        return F.log((toxic + 0.1) / (n_toxic + 1.0)) - F.log((clean + 0.1) / (n_clean + 1.0))

    vocabulary = counts.count()
    base = n_toxic / (n_toxic + n_clean)
    n, t = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    # n times the divergence of the share of toxic texts from the base rate
    evidence = n * (t * F.log(t / base) + F.when(t < 1, (1 - t) * F.log((1 - t) / (1 - base))).otherwise(0.0))

    def top(rows: DataFrame, ways: int = 1) -> dict[str, float]:
        got = (rows.where((F.col("toxic") > 0) & (F.col("weight") >= MIN_LOG_ODDS))
               .where(evidence >= math.log(max(2, vocabulary * ways)) + SURE)
               .orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "word").limit(MAX_ARCS).select("word", "weight"))
        return {r[0]: float(r[1]) for r in got.collect()}

    found = top(counts.withColumn("weight", odds(F.col("toxic"), F.col("clean"))))
    # a stem stands for words not seen yet: nearly no clean text may hold a word of it
    cut = F.explode(F.sequence(F.lit(STEM_LETTERS), F.least(F.length("word") - 1, F.lit(STEM_LONGEST)))).alias("n")
    parts = (counts.where(f"length(word) > {STEM_LETTERS}").select("word", "toxic", "clean", cut)
             .withColumn("stem", F.expr("substring(word, 1, n)")))
    stems = (parts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                                       F.sum((F.col("toxic") > F.col("clean")).cast("int")).alias("kinds"))
             .where((F.col("kinds") >= STEM_WORDS) & (F.col("clean") * 30 <= F.col("toxic")) & (F.col("toxic") >= 8))
             .withColumnRenamed("stem", "word").withColumn("weight", odds(F.col("toxic"), F.col("clean"))))
    pure = top(stems, STEM_LONGEST - STEM_LETTERS + 1)
    pure = {s: w for s, w in pure.items() if not any(s[:k] in pure for k in range(STEM_LETTERS, len(s)))}
    seen = {r[0]: r[1] for r in counts.where(F.col("word").isin(*THREATS) & (F.col("toxic") + F.col("clean") >= 5))
            .select("word", odds(F.col("toxic"), F.col("clean"))).collect()}
    threats = {t: min(THREAT_WEIGHT, max(0.0, float(seen.get(t, THREAT_WEIGHT)))) for t in THREATS}
    return found, pure, {t: w for t, w in threats.items() if w > 0.3}


class ToxicityModel:
    """A fitted grammar; at most a few thousand arcs."""

    def __init__(self, grammar: Grammar) -> None:
        self.grammar = grammar

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
        """Fit on at most ``sample_rows`` of ``labels`` (smallest id hashes; NULL labels and ids left out).

        Without labels of both kinds the grammar keeps its own lists and a fixed curve.
        """
        some = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"),
                        F.xxhash64(F.col(id_col).cast("string")).alias("_order"))
                .orderBy("_order", "_id").limit(sample_rows))
        texts = stage(docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
                      .join(F.broadcast(some), F.col("_doc") == F.col("_id")).select("text", "label", "_order"),
                      "toxicity-sample")
        # the curve is fitted on texts that the arcs it sees were not learnt from
        fold = F.pmod("_order", F.lit(3)) == 0
        trial = cls(Grammar(*learn_arcs(texts.where(~fold))))
        rows = trial._readings(texts.where(fold))
        model = cls(Grammar(*learn_arcs(texts)))
        if not len(rows) or rows[:, 0].min() == rows[:, 0].max():
            rows = model._readings(texts)
        if len(rows) and rows[:, 0].min() != rows[:, 0].max():
            model.grammar.curve = fit_curve(rows[np.lexsort(rows.T)])
        return model

    def _readings(self, texts: DataFrame) -> np.ndarray:
        got = texts.select("text", "label").mapInArrow(
            self._reader(texts.sparkSession, 1), "label int, best double, total double, dense double")
        return np.array([tuple(r) for r in got.toLocalIterator()], dtype=float).reshape(-1, 4)

    def _reader(self, spark, keep: int):
        shared = share(spark, self.grammar)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grammar = shared()
            arcs = grammar.automaton()
            for batch in batches:
                got = [grammar.read(t, arcs) for t in batch.column(1 - keep).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(keep), *[pa.array([g[j] for g in got], pa.float64()) for j in range(3)]],
                    names=[batch.schema.names[keep], "best", "total", "dense"])
        return run

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(doc_id, score, best, total, dense)`` per row: probability, heaviest clause, sum, sum per length.

        A NULL or empty text has no clause and gets the curve's value for weight 0.
        """
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        kind = rows.schema["doc_id"].dataType.simpleString()
        read = rows.mapInArrow(self._reader(docs.sparkSession, 0),
                               f"doc_id {kind}, best double, total double, dense double")
        a, b, c, d = self.grammar.curve
        logit = F.lit(a) + b * F.log1p("best") + c * F.log1p("total") + d * F.log1p("dense")
        return read.select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"), "best", "total", "dense")


def fit_curve(rows: np.ndarray) -> tuple[float, float, float, float]:
    """Logistic regression of the label on log1p of best, total and dense, by Newton steps with a small ridge.

    No weight is negative: more insult never lowers a score.
    """
    y, x = rows[:, 0], np.column_stack([np.ones(len(rows)), np.log1p(rows[:, 1:])])
    used = np.ones(4, dtype=bool)
    while True:
        w, z = np.zeros(used.sum()), x[:, used]
        ridge = np.diag(np.where(np.arange(used.sum()) == 0, 1e-3, 5e-2))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if (w[1:] >= 0).all():
            break
        used[np.flatnonzero(used)[1:][w[1:] < 0]] = False
    out = np.zeros(4)
    out[used] = w
    return tuple(float(v) for v in out)
