"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

* Every word form and every word *shape* (runs of letters, capitals, digits and each
  other sign, runs collapsed) has a fixed sparse ternary index vector derived from its hash.
* A word's vector is the sum of the index vectors seen within ``WINDOW`` words of it over the texts of
  all documents, labelled or not, normalised, plus its own shape's index vector. Tasks sum per
  word form, and Spark brings the partial sums of a form together. The table holds every form of
  two documents or more; a form of one document has all its contexts there, and its vector is made
  from that document when it is read.
* A document is the mean of its words' vectors, the mean likeness of two of its words (high
  when few words repeat), and its length on a log scale.
* A network with one hidden layer is trained with NumPy on a bounded sample of labelled rows;
  a fifth of the sample is set aside to fit the temperature of its probabilities.

Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import Powers, Words, blocks, mix, stage

INDEX_ROWS, DIM, WINDOW, HIDDEN = 1 << 13, 64, 2, 32
#: Labelled rows used for fitting the network at most.
SAMPLE_ROWS = 8_000
BLOCK = 1 << 19
#: Word forms that a task sums before it hands the sums on.
HELD = 1 << 19


def index_table() -> np.ndarray:
    """Sparse ternary index vectors, four non-zero entries each; the same in every task."""
    rng = np.random.default_rng(5)
    out = np.zeros((INDEX_ROWS, DIM), dtype=np.float32)
    rows = np.arange(INDEX_ROWS)
    for _ in range(4):
        out[rows, rng.integers(0, DIM, INDEX_ROWS)] += rng.choice([-1.0, 1.0], INDEX_ROWS)
    return out


def index_vectors(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index vector of each hash."""
    return table[(hashes & np.uint64(INDEX_ROWS - 1)).astype(np.int64)]


def shape_hashes(words: Words, powers: Powers) -> np.ndarray:
    """Hash of each word's shape: classes of its bytes with runs collapsed."""
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("a"):ord("z") + 1] = 1
    kind[128:] = 1
    kind[ord("A"):ord("Z") + 1] = 2
    kind[ord("0"):ord("9") + 1] = 3
    shape = kind[words.data]
    new = np.ones(len(shape), dtype=bool)
    new[1:] = shape[1:] != shape[:-1]
    new[words.start] = True
    at = np.concatenate([[0], np.cumsum(new)])
    picked = shape[new].astype(np.uint64) + np.uint64(1)
    up, down = powers.upto(len(picked) + 1)
    total = np.zeros(len(picked) + 1, dtype=np.uint64)
    np.cumsum(picked * up[:len(picked)], out=total[1:])
    return mix((total[at[words.end]] - total[at[words.start]]) * down[at[words.start]] + np.uint64(7))


def contexts(form: np.ndarray, shape: np.ndarray, doc: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Sum of the index vectors (``small``: whole numbers) within ``WINDOW`` words of each word, in the same document."""
    at = np.arange(len(doc)) + WINDOW * (doc + 1)
    index = np.zeros((int(at[-1]) + WINDOW + 1, DIM), dtype=np.int8)  # documents stand WINDOW empty rows apart
    index[at] = index_vectors(form, small) + index_vectors(shape, small)
    out = np.zeros_like(index)
    for step in range(1, WINDOW + 1):
        out[step:] += index[:-step]
        out[:-step] += index[step:]
    return out[at]


def starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before it."""
    new = np.zeros(len(sorted_columns[0]), dtype=bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def grouped(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Like ``np.add.reduceat`` over rows, each group in row order: the k-th rows of all groups at once, a few long groups by themselves."""
    size = np.diff(np.append(cuts, len(x)))
    out, left, k = x[cuts], np.arange(len(cuts)), 1
    while True:
        left = left[size[left] > k]
        if len(left) < 32:
            for i in left.tolist():
                out[i] = x[cuts[i]:cuts[i] + size[i]].sum(axis=0)
            return out
        out[left] += x[cuts[left] + k]
        k += 1


def added(keys: np.ndarray, docs: np.ndarray, sums: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of equal key added up, in key order, some thousand keys at a time."""
    order = np.argsort(keys, kind="stable")
    cuts = np.append(np.flatnonzero(starts(keys[order])), len(keys))
    for k in range(0, len(cuts) - 1, 1 << 14):
        own = cuts[k:k + (1 << 14) + 1]
        rows = order[own[0]:own[-1]]
        own = own[:-1] - own[0]
        yield keys[rows[own]], np.add.reduceat(docs[rows], own), grouped(sums[rows].astype(np.int32 if sums.dtype == np.int8 else np.int64), own)


class Sums:
    """Documents and context sums per word form: small sums, which nearly all are, in a byte each, others apart.

    A form can have a row in either.
    """

    def __init__(self) -> None:
        self.parts: list[list[tuple]] = [[], []]
        self.rows, self.merged = [0, 0], [0, 0]

    def add(self, keys: np.ndarray, docs: np.ndarray, sums: np.ndarray) -> None:
        fits = (sums.max(axis=1, initial=0) < 128) & (sums.min(axis=1, initial=0) > -128)
        for big, (mask, kind) in enumerate(((fits, np.int8), (~fits, np.int64))):
            if mask.any():
                self.parts[big].append((keys[mask], docs[mask], sums[mask].astype(kind)))
                self.rows[big] += int(mask.sum())

    def settle(self, whole: bool = False) -> None:
        """Add up what has come in, if it is much or ``whole``."""
        for big, least in ((0, HELD // 2), (1, HELD // 32)):
            if self.parts[big] and (whole or self.rows[big] > least + self.merged[big]):
                old, self.parts[big], self.rows[big] = self.parts[big], [], 0
                columns = [np.concatenate(x) for x in zip(*old)]
                del old
                for part in added(*columns):
                    self.add(*part)
                self.merged[big] = self.rows[big]

    def columns(self, big: int, kind: type) -> tuple:
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, DIM), kind))
        return tuple(np.concatenate(x) for x in zip(none, *self.parts[big]))

    def all(self) -> tuple:
        """Everything, one row a form."""
        both = [np.concatenate(x) for x in zip(self.columns(0, np.int8), self.columns(1, np.int64))]
        parts = list(added(*both)) or [both]
        return tuple(np.concatenate(x) for x in zip(*parts))


def block_sums(words: Words, powers: Powers, small: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word form of a block: its hash, the documents that hold it, and its context sum."""
    form = words.hashes(powers, lower=False)
    doc = np.searchsorted(words.first, np.arange(len(form)), side="right")
    around = contexts(form, shape_hashes(words, powers), doc, small)
    order = np.argsort(form, kind="stable")
    form, doc = form[order], doc[order]
    cuts = np.flatnonzero(starts(form))
    return (form[cuts], np.add.reduceat(starts(form, doc).astype(np.int64), cuts),
            grouped(around[order].astype(np.int32), cuts))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def folded(keys: np.ndarray, docs: np.ndarray, sums: np.ndarray) -> bytes:
    """Rows of forms as bytes: keys in order as steps, all columns as planes of like bytes, compressed."""
    order = np.argsort(keys, kind="stable")
    steps = np.diff(keys[order], prepend=np.uint64(0))
    planes = [np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T),
              np.ascontiguousarray(docs[order].astype(np.int32).view(np.uint8).reshape(-1, 4).T),
              np.ascontiguousarray(sums[order].T)]
    raw = pickle.dumps(planes)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def unfolded(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``folded`` was given, in the order of the keys."""
    raw = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    steps, docs, sums = pickle.loads(raw)
    keys = np.cumsum(np.ascontiguousarray(steps.T).view(np.uint64).ravel(), dtype=np.uint64)
    return keys, np.ascontiguousarray(docs.T).view(np.int32).ravel().astype(np.int64), np.ascontiguousarray(sums.T)


def gather_contexts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and unit context vectors (in 127ths) of the word forms that two or more of ``texts`` (text) hold."""
    slices = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, small, held = Powers(), index_table().astype(np.int8), Sums()

        def out() -> Iterator[pa.RecordBatch]:
            held.settle(whole=True)
            for big, kind in enumerate((np.int8, np.int64)):
                rows = held.columns(big, kind)
                place = ((rows[0] >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
                order = np.argsort(place, kind="stable")
                ends = np.searchsorted(place[order], np.arange(slices + 1, dtype=np.uint64))
                for k in range(slices):
                    own = order[ends[k]:ends[k + 1]]
                    if len(own):
                        part = folded(rows[0][own], rows[1][own], rows[2][own])
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.binary())],
                                                         names=["slice", "sums"])

        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0), BLOCK):
                words = Words(data, offsets)
                if len(words.start):
                    held.add(*block_sums(words, powers, small))
                    held.settle()
                if held.merged[0] > HELD:
                    yield from out()
                    held = Sums()
        yield from out()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums()
        for batch in batches:
            for row in batch.column(1):
                held.add(*unfolded(row.as_py()))
                held.settle()
        keys, docs, sums = held.all()
        shared = docs > 1
        vectors = np.round(127 * unit(sums[shared].astype(np.float64))).astype(np.int8)
        yield pa.RecordBatch.from_arrays([pa.array([keys[shared].tobytes()], pa.binary()),
                                          pa.array([vectors.tobytes()], pa.binary())], names=["keys", "vectors"])

    parts = stage(texts.select("text").mapInArrow(count, "slice int, sums binary").repartition(slices, "slice")
                  .mapInArrow(meet, "keys binary, vectors binary"), "quality-words")
    keys, vectors = [np.zeros(0, np.uint64)], [np.zeros((0, DIM), np.int8)]
    for row in parts.toLocalIterator():
        keys.append(np.frombuffer(row[0], np.uint64))
        vectors.append(np.frombuffer(row[1], np.int8).reshape(-1, DIM))
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    return keys[order], np.concatenate(vectors)[order]


def word_vectors(form: np.ndarray, shape: np.ndarray, doc: np.ndarray, table: tuple[np.ndarray, np.ndarray],
                 vectors: np.ndarray) -> np.ndarray:
    """Unit context vector of each word of a block: from the table, or from its own document if only that has its form."""
    keys, known = table
    forms, which = np.unique(form, return_inverse=True)
    at = np.searchsorted(keys, forms)
    there = at < len(keys)
    there[there] = keys[at[there]] == forms[there]
    rows = np.zeros((len(forms), DIM), dtype=np.float32)
    rows[there] = known[at[there]] / np.float32(127)
    out = rows[which]
    alone = np.flatnonzero(~there[which])
    if len(alone):
        alone = alone[np.lexsort((which[alone], doc[alone]))]
        new = starts(which[alone], doc[alone])
        around = contexts(form, shape, doc, vectors.astype(np.int8))[alone]
        sums = grouped(around.astype(np.float32), np.flatnonzero(new))
        out[alone] = unit(sums)[np.cumsum(new) - 1]
    return out


FEATURES = 2 * DIM + 2


def pool(column: pa.Array, table: tuple[np.ndarray, np.ndarray], powers: Powers) -> np.ndarray:
    """Feature rows of an Arrow text column: mean word vector, mean shape vector, word likeness, log length."""
    out = np.zeros((len(column), FEATURES), dtype=np.float32)
    vectors = index_table()
    shapes = 0.5 * unit(vectors)
    for lo, hi, data, offsets in blocks(column, BLOCK):
        words = Words(data, offsets)
        if not len(words.start):
            continue
        form, shape = words.hashes(powers, lower=False), shape_hashes(words, powers)
        n = np.diff(words.first)
        some = np.flatnonzero(n)
        cuts = words.first[:-1][some]
        count = n[some][:, None].astype(np.float32)
        lowered = index_vectors(words.hashes(powers), vectors)
        doc = np.searchsorted(words.first, np.arange(len(form)), side="right")
        word = word_vectors(form, shape, doc, table, vectors) + index_vectors(shape, shapes)
        out[lo + some, :DIM] = grouped(word, cuts) / count
        out[lo + some, DIM:2 * DIM] = grouped(index_vectors(shape, vectors), cuts) / count
        total = grouped(lowered, cuts)
        own = np.add.reduceat((lowered * lowered).sum(axis=1), cuts)
        pairs = count[:, 0] * np.maximum(count[:, 0] - 1, 1)
        out[lo + some, -2] = np.clip(((total * total).sum(axis=1) - own) / pairs, -1, 4)
        out[lo + some, -1] = np.log1p(count[:, 0])
    return out


class Network:
    """Standardised inputs, one tanh layer, a logistic output divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, aside: np.ndarray) -> None:
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float((y.sum() + 0.5) / (len(y) + 1.0))
            return
        self.center, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.center) / self.scale
        rng = np.random.default_rng(11)
        p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        if aside.all() or not aside.any() or y[~aside].min() == y[~aside].max():
            aside = np.zeros(len(y), dtype=bool)
        a, t = z[~aside], y[~aside]
        weight = np.where(t == 1, 0.5 / max(t.mean(), 1e-9), 0.5 / max(1 - t.mean(), 1e-9)) ** 0.5
        weight /= weight.mean()
        m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
        step = 0
        for _ in range(60):
            order = rng.permutation(len(t))
            for k in range(0, len(t), 256):
                rows = order[k:k + 256]
                b, h = a[rows], np.tanh(a[rows] @ p[0] + p[1])
                err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t[rows]) * weight[rows] / len(rows)
                back = np.outer(err, p[2]) * (1 - h * h)
                grads = [b.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ err + 1e-4 * p[2], np.array([err.sum()])]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] - 0.005 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.params, self.temperature = p, 1.0
        rows = aside if aside.any() else ~aside
        logits, t = self.logits(x[rows]), y[rows]
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, -np.where(t == 1, 1, -1) * logits / g)) for g in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        p = self.params
        return np.tanh(z @ p[0] + p[1]) @ p[2] + p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class QualityModel:
    """Word table, as a broadcast that grows with the vocabulary (72 bytes a form), and network."""

    def __init__(self, table: Broadcast, network: Network) -> None:
        self.table, self.network = table, network

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
        """Word vectors from all texts of ``docs``; the network from at most ``sample_rows`` of ``labels`` (those with
        the smallest id hashes; NULL labels and ids left out).

        No labelled text, or labels all alike, gives a constant score.
        """
        some = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"),
                        F.xxhash64(F.col(id_col).cast("string")).alias("_order"))
                .orderBy("_order", "_id").limit(sample_rows))
        texts = (docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text"))
                 .join(F.broadcast(some), F.col("_doc") == F.col("_id")))
        table = docs.sparkSession.sparkContext.broadcast(
            gather_contexts(docs.select(F.col(text_col).cast("string").alias("text"))))

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            for batch in batches:
                x = pool(batch.column(0), table.value, powers)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["label", "order", "x"])

        rows = sorted((tuple(r) for r in texts.select("text", "_label", "_order").mapInArrow(
            features, "label int, order long, x binary").toLocalIterator()), key=lambda r: (r[1], r[0], bytes(r[2])))
        x = np.array([np.frombuffer(r[2], dtype=np.float32) for r in rows], dtype=np.float64).reshape(len(rows), FEATURES)
        y = np.array([r[0] for r in rows], dtype=np.float64)
        aside = np.array([r[1] % 5 == 0 for r in rows], dtype=bool)
        return cls(table, Network(x, y, aside))

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(doc_id, score)`` per row, 0 to 1; NULL and empty texts are scored as documents of no words."""
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        table, network = self.table, self.network

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            for batch in batches:
                score = network.score(pool(batch.column(1), table.value, powers).astype(np.float64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())],
                                                 names=["doc_id", "score"])

        return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
