"""Quality classifier: random-indexing word vectors pooled per document, a two-layer numpy
network and temperature-calibrated probabilities.

1. Random indexing over all documents: a token (run of letters, or of other
   marks) has a sparse ternary index vector given by its hash; the word vector
   of a hash bucket is the sum of the index vectors of all neighbours within
   two places. Tasks add up integer matrices of a fixed size, which are merged
   by a tree reduction (exact whatever the order).
2. Pooling: mean word vector and mean index vector of a document's tokens,
   their lengths, and how often neighbours agree. Long and short texts pool
   alike, whole texts are read.
3. A network (tanh layer, logistic output) is fitted on at most ``SAMPLE``
   labelled rows outside the held-out fold; a fifth of them is kept from the
   fit to choose the temperature that calibrates its logits.

Scores depend on the text alone. Defined cases: null, empty or token-free
texts have a zero vector and the score of that vector; rows with a null id
are scored and never learned from; repeated rows score alike; without usable
labels of both kinds every score is the share of label 1 (0.5 if unlabelled);
an empty table gives an empty result; only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.labels import SAMPLE, held_out, training_labels
from ledgerwatch.llm.spread import cut, text_batches, tree_sum
from ledgerwatch.llm.text import as_binary, blocks, mix, tokens_of

BUCKETS, DIM, NONZERO, REACH = 1 << 14, 32, 4, 2
HIDDEN, STEPS, RATE, DECAY = 32, 600, 0.02, 1e-4
FEATURES = 2 * DIM + 2 + REACH + 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every bucket's index vector."""
    b = np.arange(BUCKETS, dtype=np.uint64)
    h = np.stack([mix(b, 900 + j) for j in range(NONZERO)], axis=1)
    step = DIM // NONZERO  # one entry in each quarter: the places never meet
    place = (h % np.uint64(step)).astype(np.int64) + np.arange(NONZERO) * step
    return place, np.where(h >> np.uint64(63), 1, -1).astype(np.int64)


def _adder():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(BUCKETS * DIM, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                words = tokens_of(data, offsets)
                b = (words.hash % np.uint64(BUCKETS)).astype(np.int64)
                row = words.row
                for gap in range(1, REACH + 1):
                    same = row[gap:] == row[:-gap]
                    left, right = b[:-gap][same], b[gap:][same]
                    for one, other in ((left, right), (right, left)):
                        for j in range(NONZERO):
                            total += np.bincount(one * DIM + place[other, j], weights=sign[other, j],
                                                 minlength=BUCKETS * DIM).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["matrix"])
    return run


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Unit word vectors of all buckets (a fixed-size matrix) from one text column, over all rows."""
    total = tree_sum(texts.mapInArrow(_adder(), "matrix binary"), "matrix")
    total = np.zeros(BUCKETS * DIM, dtype=np.int64) if total is None else total
    matrix = total.reshape(BUCKETS, DIM).astype(np.float64)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return (matrix / np.where(norm > 0, norm, 1)).astype(np.float32)


def pool(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """(rows, FEATURES) pooled features of a block of texts."""
    words = tokens_of(data, offsets)
    b = (words.hash % np.uint64(BUCKETS)).astype(np.int64)
    n = np.diff(words.first)
    out = np.zeros((words.n_rows, FEATURES), dtype=np.float32)
    live = np.flatnonzero(n)
    if not len(live):
        return out
    share = n[live, None].astype(np.float32)
    for k, table in enumerate((vectors, index)):
        mean = np.add.reduceat(table[b], words.first[live], axis=0) / share
        out[live, k * DIM:(k + 1) * DIM] = mean
        out[live, 2 * DIM + k] = np.linalg.norm(mean, axis=1)
    row = words.row
    for gap in range(1, REACH + 1):
        agree = (b[gap:] == b[:-gap]) & (row[gap:] == row[:-gap])
        out[live, 2 * DIM + 1 + gap] = np.bincount(row[gap:][agree], minlength=words.n_rows)[live] / n[live]
    out[live, -1] = np.log1p(n[live]) / 10
    return out


def _pooler(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        index = np.zeros((BUCKETS, DIM), dtype=np.float32)
        np.put_along_axis(index, place, sign.astype(np.float32), axis=1)
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                x = pool(data, offsets, vectors, index)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), as_binary(x.reshape(-1), np.arange(hi - lo + 1) * FEATURES)],
                    names=["id", "features"])
    return run


class Network:
    """Two layers, fitted by full-batch Adam on standardised features; logits over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(y))
        fit, rest = order[len(y) // 5:], order[:len(y) // 5]
        if y[fit].min() == y[fit].max():
            fit = order
        self.p = [rng.normal(0, (1 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        xf, yf = x[fit], y[fit]
        for t in range(1, STEPS + 1):
            hidden = np.tanh(xf @ self.p[0] + self.p[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ self.p[2] + self.p[3], -30, 30))) - yf) / len(yf)
            back = np.outer(error, self.p[2]) * (1 - hidden ** 2)
            grads = [xf.T @ back + DECAY * self.p[0], back.sum(axis=0), hidden.T @ error + DECAY * self.p[2],
                     np.array([error.sum()])]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                self.p[i] = self.p[i] - RATE * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.temperature = self._temperature(x[rest], y[rest]) if len(rest) else 1.0

    def _logits(self, x: np.ndarray) -> np.ndarray:
        """Sums run feature by feature: a matrix product may sum a row in an order that depends on the other rows."""
        hidden = np.tile(self.p[1], (len(x), 1))
        for j in range(x.shape[1]):
            hidden += x[:, j, None] * self.p[0][j]
        hidden = np.tanh(hidden)
        z = np.full(len(x), self.p[3][0])
        for j in range(hidden.shape[1]):
            z += hidden[:, j] * self.p[2][j]
        return z

    def _temperature(self, x: np.ndarray, y: np.ndarray) -> float:
        z, grid = self._logits(x), np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.logaddexp(0, np.where(y > 0, -z, z) / t).mean() for t in grid]
        return float(grid[int(np.argmin(loss))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self._logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, FEATURES).astype(np.float64)


def _scorer(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.scores(_matrix(batch.column(1))))],
                                             names=["id", "score"])
    return run


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3,
                  sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score (probability of label 1), predicted (score >= threshold)."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    vectors = word_vectors(source.select("text"))
    pooled = cut(source.mapInArrow(_pooler(vectors), f"id {kind}, features binary"))
    wanted = training_labels(labels, label_col, limit=sample)  # bounded by the sample size
    train = pooled.join(F.broadcast(wanted), F.col("id") == F.col("train_id")).select("id", "features", "label") \
        .groupBy("id").agg(F.min("features").alias("features"), F.max("label").alias("label")).orderBy("id").toPandas()
    x = np.frombuffer(b"".join(bytes(f) for f in train["features"]), dtype=np.float32).reshape(-1, FEATURES)
    network = Network(x.astype(np.float64), (train["label"].to_numpy() > 0).astype(np.float64))
    return pooled.mapInArrow(_scorer(network), f"id {kind}, score double").select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
