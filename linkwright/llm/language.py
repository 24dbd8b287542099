"""Language identification by a blended-spectrum string kernel.

A text is the set of its 1-, 2- and 3-grams over lower-cased letters (any run of other
characters is one space), hashed to ``GRAMS`` places: presence, not frequency. The kernel of
two texts is the size of the intersection over the geometric mean of the set sizes. Nyström
landmarks (texts of the training sample, drawn evenly per language) turn it into a fixed
feature map; one-versus-rest kernel ridge regression gives a weight per landmark and
language. A batch is scored by two matrix products. A temperature fitted on rows set aside
turns the outputs into a probability.

Only text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import share, stage

GRAMS, ORDERS, LANDMARKS, RIDGE = 1 << 13, 3, 128, 1e-3
#: Training rows per language on average, with up to so many languages; with more, all are learnt from fewer rows each.
ROWS_PER_LANGUAGE, MAX_LANGUAGES = 1_000, 500
UNKNOWN = "und"
ROWS = 256


def letter_table() -> np.ndarray:
    """For each code point of the basic plane: itself if a letter, else 0."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(1 << 16)], dtype=np.uint32)


def presence(texts: list[str | None], letters: np.ndarray) -> np.ndarray:
    """Rows of 0/1: which hashed n-grams a text has. A text without letters has none."""
    out = np.zeros((len(texts), GRAMS), dtype=np.float32)
    for row, text in enumerate(texts):
        if not text:
            continue
        for at in range(0, len(text), 1 << 18):  # pieces overlap by two characters, so no n-gram is lost
            piece = text[max(0, at - ORDERS + 1):at + (1 << 18)].lower().encode("utf-32-le", "surrogatepass")
            code = np.frombuffer(piece, dtype=np.uint32)
            code = np.where(code < (1 << 16), letters[np.minimum(code, (1 << 16) - 1)], code)
            gap = code == 0
            code = code[~(gap & np.concatenate([[False], gap[:-1]]))].astype(np.uint64)
            if not code.any():
                continue
            gram = np.zeros(len(code), dtype=np.uint64)
            for n in range(ORDERS):
                if len(code) <= n:
                    break
                gram = gram[:len(code) - n] * np.uint64(0x100000001B3) + code[n:] + np.uint64(1)
                place = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)
                out[row, place[code[:len(code) - n] > 0] if n == 0 else place] = 1.0
    return out


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1.0))


class LanguageModel:
    """Landmarks and their weights per language."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray, temperature: float) -> None:
        self.languages, self.landmarks, self.weights, self.temperature = languages, landmarks, weights, temperature

    @classmethod
    def fit(cls, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            rows_per_language: int = ROWS_PER_LANGUAGE, landmarks: int = LANDMARKS) -> LanguageModel:
        """Fit on about ``rows_per_language`` rows of each language, chosen by a hash of the id.

        Rows with a NULL language, id or text are left out. Of over ``MAX_LANGUAGES`` languages each has fewer
        rows and landmarks, one at least. Without any row, every prediction is ``und``.
        """
        rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text")).where(
            "_id is not null and lang is not null and text is not null")
        order = F.xxhash64(F.col("_id").cast("string"))
        share = stage(rows.groupBy("lang").agg(F.count("*").alias("_n"), F.min(order).alias("_least")), "languages")
        each = max(1, rows_per_language * MAX_LANGUAGES // max(MAX_LANGUAGES, share.count()))
        some = (rows.join(F.broadcast(share), "lang")
                .where((F.pmod(order, F.lit(1_000_003)) * F.col("_n") < F.lit(1_000_003 * each)) | (order == F.col("_least"))))

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            letters = letter_table()
            for batch in batches:
                x = presence(batch.column(2).to_pylist(), letters)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([np.packbits(r > 0).tobytes() for r in x], pa.binary())],
                    names=["lang", "order", "x"])

        got = sorted(tuple(r) for r in some.select("lang", order.alias("order"), "text").mapInArrow(
            features, "lang string, order long, x binary").toLocalIterator())
        languages = sorted({r[0] for r in got})
        if not languages:
            return cls([], np.zeros((0, GRAMS), np.float32), np.zeros((0, 0)), 1.0)
        x = normalised(np.unpackbits(np.frombuffer(b"".join(r[2] for r in got), np.uint8)).reshape(-1, GRAMS)
                       .astype(np.float32))
        place = {name: k for k, name in enumerate(languages)}
        lang = np.array([place[r[0]] for r in got])
        turn = np.arange(len(got)) - np.searchsorted(lang, lang)  # how many of its language come before: landmarks take turns
        marks = x[np.lexsort((lang, turn))[:max(landmarks, min(2 * len(languages), 2 * MAX_LANGUAGES), len(languages))]]
        gram = (marks @ marks.T).astype(np.float64)
        values, vectors = np.linalg.eigh(gram)
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        aside = (turn % 5 == 4)
        target = np.where(lang[:, None] == np.arange(len(languages)), 1.0, -1.0)

        def solve(rows_: np.ndarray) -> np.ndarray:
            phi = (x[rows_] @ marks.T).astype(np.float64) @ root
            return root @ np.linalg.solve(phi.T @ phi + RIDGE * len(phi) * np.eye(phi.shape[1]), phi.T @ target[rows_])

        temperature = 0.1
        if aside.any() and len(languages) > 1:
            out = (x[aside] @ marks.T).astype(np.float64) @ solve(~aside)
            grid, truth = np.geomspace(0.02, 2, 41), lang[aside]
            loss = []
            for t in grid:
                z = out / t - (out / t).max(axis=1, keepdims=True)
                loss.append(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]))
            temperature = float(grid[int(np.argmin(loss))])
        return cls(languages, marks, solve(np.ones(len(x), dtype=bool)), temperature)

    def predict(self, texts: list[str | None], letters: np.ndarray) -> tuple[list[str], list[float]]:
        """Language and probability of each text; ``und`` and 0 for a text without a letter."""
        langs, scores = [], []
        for at in range(0, len(texts), ROWS):
            some = texts[at:at + ROWS]
            x = presence(some, letters)
            lettered = x.any(axis=1) & np.array([bool(t) and any(map(str.isalpha, t)) for t in some])
            if not self.languages:
                lettered[:] = False
            else:
                out = (normalised(x) @ self.landmarks.T).astype(np.float64) @ self.weights / self.temperature
                z = np.exp(out - out.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                best = z.argmax(axis=1)
            for k in range(len(some)):
                langs.append(self.languages[best[k]] if lettered[k] else UNKNOWN)
                scores.append(float(z[k, best[k]]) if lettered[k] else 0.0)
        return langs, scores

    def label(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(doc_id, lang_pred, score)`` per row; NULL texts and texts without a letter are ``und`` with score 0."""
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        shared = share(docs.sparkSession, self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, letters = shared(), letter_table()
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS):
                    part = batch.slice(lo, ROWS)
                    langs, scores = model.predict(part.column(1).to_pylist(), letters)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                        names=["doc_id", "lang_pred", "score"])

        return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                    "lang_pred string, score double")
