"""Toxicity by weak supervision.

1. Markers: words and word beginnings of toxic training rows, chosen by the
   evidence of their counts among toxic and other rows (log-likelihood ratio
   and smoothed log-odds). Groups of near copies count once, so that copying a
   text does not turn its words into markers.
2. Voters: the markers are dealt into lexicon voters (whole words) and pattern
   voters (word beginnings); a voter fires where a text holds one of its markers.
3. Label model: a generative two-class model of the votes. Expectation-
   maximisation estimates each voter's accuracy (its firing rates in both
   classes); pairwise correlations within the classes then divide the weight
   of voters that repeat each other. It yields posterior labels.
4. A linear (logistic) classifier on the presence of markers is trained on the
   posterior labels, and scores every whole text.

Steps 1 to 4 are fitted on at most ``SAMPLE`` labelled rows outside the
held-out fold, ``TOXIC_SAMPLE`` of them toxic; only the marker vocabulary and weights go out to the tasks.
Scores depend on the text alone.

Defined cases: null, empty and marker-free texts score by the classifier's
intercept; rows with a null id are scored and never learned from; repeated
rows score alike; without labelled rows of both kinds every score is 0; an
empty table gives an empty result; only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.labels import SAMPLE, held_out, training_labels
from ledgerwatch.llm.spread import cut, text_batches, tree_sum
from ledgerwatch.llm.text import as_binary, blocks, letters_of, mix

TOXIC_SAMPLE = 4_000    # most toxic rows that markers are drawn from
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of a word that pattern voters look at
CANDIDATES = 100_000    # marker candidates counted over the whole sample
MARKERS = 1024          # vocabulary of the linear classifier
VOTERS = 128            # of each kind
LEAST_ODDS, LEAST_EVIDENCE = np.log(100), 9.0  # in nats
ROUNDS, FIT_STEPS, RIDGE = 50, 800, 1e-5
_WORD, _BEGIN = np.uint64(0), np.uint64(1)


def marker_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and word beginning; the lowest bit tells which."""
    words = letters_of(data, offsets)
    row = words.row
    rows, hashes = [row], [words.hash >> np.uint64(1) << np.uint64(1)]
    length = words.end - words.start
    for n in BEGINNINGS:
        long = length > n
        rows.append(row[long])
        hashes.append(mix(words.prefix_hash(n), n)[long] | _BEGIN)
    return np.concatenate(rows), np.concatenate(hashes)


def _collector(only: np.ndarray | None):
    """Distinct marker hashes of each text, all or those in a sorted array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                row, h = marker_hashes(data, offsets)
                if only is not None:
                    at = np.minimum(np.searchsorted(only, h), max(len(only) - 1, 0))
                    good = only[at] == h if len(only) else np.zeros(len(h), dtype=bool)
                    row, h = row[good], h[good]
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                keep = np.ones(len(h), dtype=bool)
                keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                first = np.searchsorted(row[keep], np.arange(hi - lo + 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), as_binary(h[keep], first)], names=["label", "markers"])
    return run


def _counter(values: np.ndarray):
    """Texts of a task that hold each of the sorted hashes, and the number of texts, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(values) + 1, dtype=np.int64)
        for batch in _collector(values)(batches):
            flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint64)
            total[:-1] += np.bincount(np.searchsorted(values, flat), minlength=len(values))
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["counts"])
    return run


def near_copies(sets: list[np.ndarray], k: int = 16) -> np.ndarray:
    """Group number of each set: sets that share half of their k least members are near copies."""
    root = np.arange(len(sets))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    seen: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        shared: dict[int, int] = {}
        for h in s[:k].tolist():
            group = seen.setdefault(h, [])
            for j in group:
                shared[j] = shared.get(j, 0) + 1
            group.append(i)
        for j, n in shared.items():
            if 2 * n >= k:
                root[find(i)] = find(j)
    return np.array([find(i) for i in range(len(sets))], dtype=np.int64)


def candidates(toxic_sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (sorted) in the most groups of toxic texts, their group counts, and the number of groups."""
    group = near_copies(toxic_sets)
    if not len(group):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 0
    flat = np.concatenate(toxic_sets)
    owner = np.repeat(group, [len(s) for s in toxic_sets])
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    values, count = np.unique(flat[new], return_counts=True)
    best = np.sort(np.argsort(-count, kind="stable")[:CANDIDATES])
    return values[best], count[best], len(np.unique(group))


class Vocabulary:
    """Markers by smoothed log-odds, strongest first."""

    def __init__(self, values: np.ndarray, in1: np.ndarray, n1: int, in0: np.ndarray, n0: int):
        """Candidates, and the groups of toxic texts and the other texts (of n1 and n0) that hold them."""
        odds = np.log((in1 + 0.1) / (n1 + 0.2)) - np.log((in0 + 0.1) / (n0 + 0.2))
        # evidence: log-likelihood ratio of the marker's split against the share of toxic texts, in nats
        share = n1 / (n1 + n0)
        both = in1 + in0
        evidence = in1 * np.log(np.maximum(in1, 1e-9) / (both * share)) \
            + in0 * np.log(np.maximum(in0, 1e-9) / (both * (1 - share)))
        strong = np.flatnonzero((odds >= LEAST_ODDS) & (evidence >= LEAST_EVIDENCE))
        if not len(strong):
            strong = np.flatnonzero(odds > 0)
        order = strong[np.argsort(-evidence[strong], kind="stable")][:MARKERS]
        self.hashes = values[order]
        self.sorted = np.sort(self.hashes)
        self.rank = np.argsort(self.hashes, kind="stable")
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[(self.sorted >> np.uint64(40)).astype(np.int64) & 0xFFFF] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in h, marker numbers) of the markers among the hashes."""
        if not len(self.sorted):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        maybe = np.flatnonzero(self.filter[(h >> np.uint64(40)).astype(np.int64) & 0xFFFF])
        at = np.minimum(np.searchsorted(self.sorted, h[maybe]), len(self.sorted) - 1)
        good = self.sorted[at] == h[maybe]
        return maybe[good], self.rank[at[good]]

    def presence(self, row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
        x = np.zeros((n_rows, len(self.hashes)), dtype=np.float32)
        at, number = self.find(h)
        x[row[at], number] = 1
        return x


def votes(x: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """(rows, voters) 0/1: markers of each kind dealt in turn to that kind's voters, strongest first."""
    out = []
    for kind in (_WORD, _BEGIN):
        own = np.flatnonzero((hashes & np.uint64(1)) == kind)
        out += [x[:, own[v::VOTERS]].max(axis=1) for v in range(min(VOTERS, len(own)))]
    return np.stack(out, axis=1).astype(np.float64)


class LabelModel:
    """Posterior of the latent class given correlated 0/1 voters and the given label, itself a voter
    that may err."""

    def __init__(self, v: np.ndarray, given: np.ndarray):
        self.given = given
        fired = v.sum(axis=1)
        post = np.clip(0.5 * given + 0.5 * (fired > 0), 0.01, 0.99)  # start: any vote speaks for the class
        for _ in range(ROUNDS):
            self._accuracies(v, post)
            self.weight = np.ones(v.shape[1])
            post = self.posterior(v)
        self.correlation = self._correlations(v, post)
        self.weight = 1 / (1 + np.where(self.correlation > 0.1, self.correlation, 0).sum(axis=1))
        for _ in range(ROUNDS // 5):
            post = self.posterior(v)
            self._accuracies(v, post)

    def _accuracies(self, v: np.ndarray, post: np.ndarray) -> None:
        self.fire1 = np.clip((post @ v + 0.5) / (post.sum() + 1), 1e-4, 1 - 1e-4)
        rest = 1 - post
        self.fire0 = np.clip((rest @ v + 0.5 * self.fire1 * 0.01) / (rest.sum() + 1), 1e-6, 1 - 1e-4)
        self.prior = float(np.clip(post.mean(), 0.01, 0.5))
        self.right1 = np.clip((post @ self.given + 1) / (post.sum() + 2), 0.5, 0.99)
        self.wrong0 = np.clip((rest @ self.given + 1) / (rest.sum() + 2), 0.01, 0.5)
        silent = v.sum(axis=1) == 0
        self.silent1 = (post @ silent + 0.01) / (post.sum() + 1)
        self.silent0 = (rest @ silent + 0.5) / (rest.sum() + 1)

    def _correlations(self, v: np.ndarray, post: np.ndarray) -> np.ndarray:
        """Correlations between voters inside the classes, weighted by the posterior."""
        out = np.zeros((v.shape[1],) * 2)
        for p, fire in ((post, self.fire1), (1 - post, self.fire0)):
            c = v - fire
            cov = (c * p[:, None]).T @ c / max(p.sum(), 1)
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-6))
            out += p.mean() * np.abs(cov / np.outer(scale, scale))
        np.fill_diagonal(out, 0)
        return out

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Votes weigh by accuracy and independence. A voter that does not fire abstains (a text
        seldom holds more than a few markers); the silence of all voters is one vote."""
        on = np.log(self.fire1) - np.log(self.fire0)
        silence = np.log(self.silent1) - np.log(self.silent0)
        z = np.log(self.prior / (1 - self.prior)) + v @ (on * self.weight) + (v.sum(axis=1) == 0) * silence \
            + np.where(self.given > 0, np.log(self.right1 / self.wrong0),
                       np.log((1 - self.right1) / (1 - self.wrong0)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Linear:
    """Logistic regression on soft labels, by Adam on the full batch; both classes weigh the same."""

    def __init__(self, x: np.ndarray, target: np.ndarray):
        share = np.clip(target.mean(), 1e-3, 0.5)
        gain = np.stack([target * (0.5 / share), (1 - target) * (0.5 / (1 - share))], axis=1) / len(target)
        some = x.any(axis=1)  # texts without a marker are alike: they only pull at the intercept
        none = gain[~some].sum(axis=0)
        x, gain = x[some], gain[some]
        w, b = np.zeros(x.shape[1]), float(np.log(share / (1 - share)))
        m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for t in range(1, FIT_STEPS + 1):
            p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -30, 30)))
            p0 = 1 / (1 + np.exp(-np.clip(b, -30, 30)))
            error = p * gain.sum(axis=1) - gain[:, 0]
            g = np.append(x.T @ error.astype(np.float32) + RIDGE * w, error.sum() + p0 * none.sum() - none[0])
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
            w, b = w - step[:-1], float(b - step[-1])
        self.w, self.b = w, b


class Classifier:
    """Fitted from a vocabulary and its markers in toxic and other sample texts; without either, constant."""

    def __init__(self, vocabulary: Vocabulary | None = None, toxic: list[np.ndarray] = (), others: list[np.ndarray] = ()):
        self.constant = vocabulary is None or not len(vocabulary.hashes) or not len(toxic) or not len(others)
        if self.constant:
            return
        self.vocabulary = vocabulary
        sets = [*toxic, *others]
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        x = self.vocabulary.presence(row, np.concatenate(sets), len(sets))
        voted = votes(x, self.vocabulary.hashes)
        self.label_model = LabelModel(voted, np.repeat((1.0, 0.0), (len(toxic), len(others))))
        self.linear = Linear(x, self.label_model.posterior(voted))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if self.constant:
            return np.zeros(n)
        row, h = marker_hashes(data, offsets)
        at, number = self.vocabulary.find(h)
        pair = np.unique(row[at] * np.int64(len(self.vocabulary.hashes)) + number)
        z = self.linear.b + np.bincount(pair // len(self.vocabulary.hashes), minlength=n,
                                        weights=self.linear.w[pair % len(self.vocabulary.hashes)])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_classifier(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE,
                   id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    text_batches(docs.sparkSession)
    wanted = cut(training_labels(labels, label_col, limit=sample))  # bounded by the sample size
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def texts(rows: DataFrame) -> DataFrame:
        return source.join(F.broadcast(rows), F.col("id") == F.col("train_id")).select("label", "text")

    def sets(rows: DataFrame, only: np.ndarray | None) -> list[np.ndarray]:
        found = texts(rows).mapInArrow(_collector(only), "label int, markers binary").select("markers").toPandas()
        return [np.frombuffer(m, dtype=np.uint64) for m in sorted(bytes(m) for m in found["markers"])]

    toxic, others = wanted.where("label > 0"), wanted.where("label <= 0")
    values, in1, n1 = candidates(sets(toxic.orderBy(F.xxhash64("train_id"), "train_id").limit(TOXIC_SAMPLE), None))
    if not n1 or others.isEmpty():
        return Classifier()
    in0 = tree_sum(texts(others).mapInArrow(_counter(values), "counts binary"), "counts")
    if in0 is None or not in0[-1]:
        return Classifier()
    vocabulary = Vocabulary(values, in1, n1, in0[:-1], int(in0[-1]))
    return Classifier(vocabulary, sets(toxic, vocabulary.sorted), sets(others, vocabulary.sorted))


def _scorer(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo),
                                                  pa.array(model.scores(data, offsets))], names=["id", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.5,
                   sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score (probability of label 1), predicted (score >= threshold)."""
    model = fit_classifier(docs, labels, label_col, sample, id_col, text_col)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_scorer(model), f"id {kind}, score double").select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def _dropper(model: Classifier, at: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.scores(data, offsets) for _, _, data, offsets in blocks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(scores) < threshold)) if scores else batch
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.5,
               sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score below the threshold (a filter in place: no shuffle)."""
    model = fit_classifier(docs, labels, label_col, sample, id_col, text_col)
    return docs.mapInArrow(_dropper(model, docs.columns.index(text_col), threshold), docs.schema)
