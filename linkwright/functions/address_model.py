"""Trained address parser: sequence labelling by a structured perceptron.

A line is cut into tokens (words and commas), and each token gets one of ``LABELS``. A label path scores the
sum of its tokens' feature weights and of its label transitions; Viterbi finds the best path (ties to the labels
listed first). Training is iterative parameter mixing: in each epoch every task passes over its labelled lines from the
common weights and returns its averaged weights, and Spark averages these by lines. The weight table has a
fixed size (features are hashed to ``DIMENSION`` rows), so what the driver holds and sends does not grow with the data.

The rule-based ``address.parse_address_line`` needs the street first; this parser learns any order that labelled
lines show it, and both give the same struct, so matchers take either.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = ("road", "house_number", "postcode", "city", "country", "skip")
DIMENSION = 1 << 13
#: Labelled lines that training reads at most (those of smallest hash), lines of a task, passes over them.
MAX_LINES, TASK_LINES, EPOCHS = 20_000, 2_500, 10
PARSED = "road string, house_number string, postcode string, city string"
_TOKEN = re.compile(r",|[^\s,]+")


def tokens_of(line: str) -> list[str]:
    return _TOKEN.findall(line)


def token_features(tokens: list[str]) -> np.ndarray:
    """(token, feature) rows of the weight table: the word, its ends and shape, its place, its neighbours' shapes."""
    words = [t.lower() for t in tokens]
    shapes = [re.sub(r"[^\W\d_]+", "a", re.sub(r"\d", "9", w)) for w in words]
    out, segment = [], 0
    for i, w in enumerate(words):
        before = shapes[i - 1] if i else "^"
        after = shapes[i + 1] if i + 1 < len(words) else "$"
        segment += w == ","
        names = (f"w {w}", f"s {shapes[i]}", f"p {w[:3]}", f"e {w[-4:]}", f"g {min(segment, 3)} {shapes[i]}",
                 f"b {before} {shapes[i]}", f"a {shapes[i]} {after}", f"n {before} {after}", f"z {i == 0} {i + 1 == len(words)}")
        out.append([zlib.crc32(n.encode()) % DIMENSION for n in names])
    return np.array(out, dtype=np.int64).reshape(len(out), 9)


@dataclass(frozen=True)
class AddressModel:
    """``weights`` (feature, label) and ``steps`` (label or start, label)."""

    weights: np.ndarray
    steps: np.ndarray

    def path(self, tokens: list[str]) -> list[int]:
        """Label numbers of the best path."""
        if not tokens:
            return []
        scores = self.weights[token_features(tokens)].sum(axis=1)
        best, back = self.steps[-1] + scores[0], []
        for row in scores[1:]:
            via = best[:, None] + self.steps[:-1]
            back.append(via.argmax(axis=0))
            best = via.max(axis=0) + row
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]

    def parse(self, line: str) -> dict[str, str | None]:
        """Parts of a line, lower-cased; None for a part without a token. A second run of a part is left out."""
        tokens = tokens_of(line)
        found: dict[str, list[str]] = {}
        last = None
        for token, label in zip(tokens, self.path(tokens)):
            if label == last or LABELS[label] not in found:
                found.setdefault(LABELS[label], []).append(token.lower())
                last = label
            else:
                last = None
        return {part: " ".join(found[part]) if part in found else None for part in ("road", "house_number", "postcode", "city")}

    def parser(self) -> Callable[[Column], Column]:
        """A parser column for matchers: struct(road, house_number, postcode, city) of a line; NULL line, NULL parts."""
        model = self

        @F.pandas_udf(PARSED)
        def parse(lines: pd.Series) -> pd.DataFrame:
            nothing = dict.fromkeys(("road", "house_number", "postcode", "city"))
            return pd.DataFrame([model.parse(x) if isinstance(x, str) else nothing for x in lines],
                                columns=["road", "house_number", "postcode", "city"], dtype=object)

        return lambda line: parse(F.col(line) if isinstance(line, str) else line)


def _trained(model: AddressModel, lines: Iterator[tuple[list[str], list[int]]]) -> tuple[AddressModel, int]:
    """One pass of the perceptron from ``model``; the average of the weights over the pass."""
    weights, steps = model.weights.copy(), model.steps.copy()
    late_w, late_s = np.zeros_like(weights), np.zeros_like(steps)   # changes weighted by the lines before them
    n = 0
    for tokens, truth in lines:
        guess = AddressModel(weights, steps).path(tokens)
        if guess != truth:
            feats = token_features(tokens)
            for labels, sign in ((truth, 1.0), (guess, -1.0)):
                for i, label in enumerate(labels):
                    np.add.at(weights[:, label], feats[i], sign)
                    np.add.at(late_w[:, label], feats[i], sign * n)
                    before = labels[i - 1] if i else -1
                    steps[before, label] += sign
                    late_s[before, label] += sign * n
        n += 1
    return (AddressModel(weights - late_w / n, steps - late_s / n) if n else model), n


def fit(labelled: DataFrame, max_lines: int = MAX_LINES, epochs: int = EPOCHS) -> AddressModel:
    """Train on ``labelled`` (``tokens array<string>, labels array<string>``, as many labels as tokens).

    At most ``max_lines`` lines are read, those of smallest hash; without any the model labels everything alike. The
    lines are dealt out by their hash, so a rerun over the same lines gives the same model.
    """
    spark = labelled.sparkSession
    order = F.xxhash64("tokens", "labels")
    chosen = (labelled.where(F.size("tokens") == F.size("labels")).select("tokens", "labels", order.alias("h"))
              .orderBy("h").limit(max_lines).checkpoint())
    # averages over few lines learn slowly: a task gets about TASK_LINES of them
    lines = (chosen.repartition(max(1, -(-chosen.count() // TASK_LINES)), "h").sortWithinPartitions("h")
             .select("tokens", F.transform("labels", lambda x: F.array_position(F.array(*[F.lit(c) for c in LABELS]), x) - 1)
                     .alias("labels")).checkpoint())
    size = len(LABELS)
    model = AddressModel(np.zeros((DIMENSION, size)), np.zeros((size + 1, size)))
    for _ in range(epochs):
        held = spark.sparkContext.broadcast((model.weights, model.steps))   # of fixed size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (pair for b in batches for pair in zip(b["tokens"].to_pylist(), b["labels"].to_pylist()))
            made, n = _trained(AddressModel(*held.value), rows)
            flat = np.concatenate([made.weights.ravel(), made.steps.ravel()])
            cells = np.flatnonzero(flat) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({"cell": np.r_[-1, cells], "weight": np.r_[float(n), flat[cells] * n]})

        sums = lines.mapInArrow(run, "cell long, weight double").groupBy("cell").agg(F.sum("weight").alias("weight"))
        got = sums.toArrow()   # at most one row per weight
        cells, values = np.asarray(got["cell"]), np.asarray(got["weight"])
        n = values[cells == -1].sum()
        if not n:
            break
        flat = np.zeros(DIMENSION * size + (size + 1) * size)
        flat[cells[cells >= 0]] = np.round(values[cells >= 0] / n, 9)   # sums in another order differ behind that
        model = AddressModel(flat[:DIMENSION * size].reshape(DIMENSION, size), flat[DIMENSION * size:].reshape(size + 1, size))
    return model
