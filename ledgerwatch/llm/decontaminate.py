"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, exact verification.

Every benchmark item has a 256-bit SimHash of its 5-word shingles. Documents
are compared through their windows of an item's number of words, at every word:

1. A window can only reach the similarity if enough of its shingles occur in
   some item. Running counts of such shingles skip all other windows without
   loss (in clean text, all of them).
2. The SimHash of each remaining window comes from running sums of the shingle
   bits, 256 sums for any window length.
3. The fingerprint is looked up by 16 blocks of 16 bits. Two fingerprints
   within ``RADIUS`` = 63 bits differ by at most 3 bits in one block; the index
   holds every block value within 3 bits of an item's, so no fingerprint within
   the radius is missed. (At similarity 0.8 the expected distance is 39 bits
   with a deviation of 5.7.)
4. What lies within the radius is verified by the exact weighted similarity:
   shared shingles counted with multiplicity, over all of both.
5. Texts that hold an item cut short, or with words put in or left out, reach
   the similarity only in windows of another length. A row that shares enough
   shingles with an item, counted with multiplicity, and has no window of step
   4 is searched through every window length that the threshold allows, exactly
   and without fingerprints: the best window begins and ends with a shingle of
   the item, so only such windows are tried.

Items are the stated query set: they are taken in blocks of bounded size, and
each block is compared with all documents in one pass without a shuffle.

Defined cases: text is compared by words of 0x20/0x09-0x0D separated bytes,
A-Z lower-cased; null or word-free texts and items match nothing; an item of
fewer than five words is one shingle and matches only a text of exactly its
words, never a part of a longer text; each (row, item) gives one row: the best
and then leftmost window of the item's length, or of any length where none of
the item's length reaches the threshold; repeated rows each match; an empty benchmark or
table gives no match; extra columns are ignored by ``find_leaks`` and passed
through by ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerwatch.llm.spread import text_batches
from ledgerwatch.llm.text import Words, blocks, mix, words_of

BITS, WIDTH, BLOCK_RADIUS = 256, 16, 3
PARTS = BITS // WIDTH
RADIUS = PARTS * (BLOCK_RADIUS + 1) - 1
ITEMS_PER_BLOCK = 512
BYTES_PER_BLOCK = 1 << 20
SPAN, WINDOWS = 1 << 14, 1 << 14  # shingles whose running bit sums are held at once, and windows compared at once
PAIRS = 1 << 18  # (row, shingle, item) entries held at once
_index_cache: dict = {}


def shingle_bits(h: np.ndarray) -> np.ndarray:
    """(n, 256) array of +1 and -1 per shingle hash."""
    raw = np.stack([mix(h, 11 + j) for j in range(BITS // 64)], axis=1)
    return np.unpackbits(raw.view(np.uint8), axis=1).view(np.int8) * np.int8(2) - np.int8(1)


def fingerprints(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """(windows, 16) uint16 SimHash blocks of shingle ranges of one stretch of shingles."""
    total = np.zeros((len(h) + 1, BITS), dtype=np.int32)
    np.cumsum(shingle_bits(h), axis=0, dtype=np.int32, out=total[1:])
    return np.packbits(total[stop] > total[start], axis=1).view(np.uint16)


class ItemIndex:
    """Shingles, fingerprints and the multi-index of one block of benchmark items."""

    def __init__(self, texts: list[bytes], shingle: int, threshold: float):
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        words = words_of(data, offsets)
        row, h = words.shingles(shingle)
        self.threshold = threshold
        self.first = np.searchsorted(row, np.arange(len(texts) + 1))
        self.count = np.diff(self.first)            # shingles of each item
        self.length = np.diff(words.first)          # words of each item
        self.sets = [np.sort(h[a:b]) for a, b in zip(self.first[:-1], self.first[1:], strict=True)]
        self.known, place = np.unique(h, return_inverse=True)
        self.least = np.ceil(threshold * self.count - 1e-9).astype(np.int64)    # shingles a window must share
        self.widest = np.floor(self.count / threshold + 1e-9).astype(np.int64)  # shingles it may have
        # the items of each known shingle, with the shingle's count in the item
        pair, self.weight = np.unique(place.astype(np.int64) * len(texts) + row, return_counts=True)
        self.holder = pair % max(len(texts), 1)
        self.post = np.searchsorted(pair // max(len(texts), 1), np.arange(len(self.known) + 1))
        self.prints = np.zeros((len(texts), PARTS), dtype=np.uint16)
        for i in np.flatnonzero(self.count):
            self.prints[i] = fingerprints(h[self.first[i]:self.first[i + 1]], np.array([0]), self.count[i:i + 1])[0]
        self.lengths = np.unique(self.length[self.length > 0])
        masks = np.array([sum(1 << b for b in c) for r in range(BLOCK_RADIUS + 1)
                          for c in combinations(range(WIDTH), r)], dtype=np.uint64)
        live = np.flatnonzero(self.length > 0)
        part = np.arange(PARTS, dtype=np.uint64)
        keys = (self._key(self.length[live, None], part[None, :], self.prints[live])[:, :, None] ^ masks)
        owner = np.broadcast_to(live[:, None, None].astype(np.int32), keys.shape).reshape(-1)
        order = np.argsort(keys.reshape(-1), kind="stable")
        self.keys, self.owner = keys.reshape(-1)[order], owner[order]

    @staticmethod
    def _key(length, part, value) -> np.ndarray:
        return (np.asarray(length).astype(np.uint64) << np.uint64(20)) | (part << np.uint64(16)) | value.astype(np.uint64)

    def lookup(self, length: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within RADIUS, by the multi-index."""
        key = self._key(length[:, None], np.arange(PARTS, dtype=np.uint64)[None, :], prints).reshape(-1)
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        n = hi - lo
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        window = np.repeat(np.arange(len(key)) // PARTS, n)
        pair = np.unique(window * np.int64(len(self.sets)) + self.owner[at])
        window, item = pair // len(self.sets), pair % len(self.sets)
        distance = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1, dtype=np.int64)
        near = distance <= RADIUS
        return window[near], item[near], distance[near]


    def sharing(self, row: np.ndarray, place: np.ndarray) -> list[tuple[int, int]]:
        """The (row, item) pairs that share enough shingles for some window. ``row`` (ascending) and ``place``
        name the known shingles of the rows."""
        key, count = np.unique(row.astype(np.int64) * len(self.known) + place, return_counts=True)
        row, place = key // len(self.known), key % len(self.known)
        n = self.post[place + 1] - self.post[place]
        total = np.concatenate(([0], np.cumsum(n)))
        edges = np.concatenate((np.flatnonzero(np.diff(row, prepend=-1)), [len(row)]))  # where rows begin
        out, lo = [], 0
        while lo < len(edges) - 1:  # whole rows; one of them has at most as many entries as the index
            hi = max(lo + 1, int(np.searchsorted(total[edges], total[edges[lo]] + PAIRS, side="right")) - 1)
            a, b = edges[lo], edges[hi]
            m = n[a:b]
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(self.post[place[a:b]], m)
            pair, back = np.unique(np.repeat(row[a:b], m) * len(self.sets) + self.holder[at], return_inverse=True)
            shared = np.bincount(back, np.minimum(np.repeat(count[a:b], m), self.weight[at]), len(pair))
            pair = pair[shared >= self.least[pair % len(self.sets)]]
            out += zip((pair // len(self.sets)).tolist(), (pair % len(self.sets)).tolist(), strict=True)
            lo = hi
        return out

    def best_window(self, h: np.ndarray, item: int) -> tuple[float, int, int] | None:
        """(similarity, first shingle, last shingle + 1) of the best, then leftmost window of any length, if one
        reaches the threshold. ``h``: the shingles of one row."""
        own = self.sets[item]
        at = np.flatnonzero(own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h)
        least, widest, size = int(self.least[item]), int(self.widest[item]), int(self.count[item])
        if len(at) < least:
            return None
        begin = np.flatnonzero(at[least - 1:] - at[:len(at) - least + 1] < widest)  # enough of them within reach
        weight = dict(zip(*(x.tolist() for x in np.unique(own, return_counts=True)), strict=True))
        place, value, best = at.tolist(), h[at].tolist(), None
        for i in begin.tolist():
            left, shared = dict(weight), 0
            for j in range(i, len(place)):
                span = place[j] - place[i] + 1
                if span > widest:
                    break
                if left[value[j]]:
                    left[value[j]] -= 1
                    shared += 1
                score = shared / (size + span - shared)
                if score >= self.threshold and (best is None or score > best[0]):
                    best = (score, place[i], place[j] + 1)
        return best


def _candidates(words: Words, row: np.ndarray, hit: np.ndarray, index: ItemIndex, k: int):
    """(first shingle, last shingle + 1, words) of every window that could reach the threshold."""
    total = np.concatenate(([0], np.cumsum(hit)))
    first = np.searchsorted(row, np.arange(words.n_rows + 1))
    n_words = np.diff(words.first)
    for length in index.lengths:
        span = max(length - k + 1, 1)
        least = max(1, int(np.ceil(index.threshold * span - 1e-9)))
        if length < k:   # such a window is a whole short text: only texts of the same length hold it as a shingle
            rows = np.flatnonzero(n_words == length)
            a = first[rows]
        else:
            a = np.flatnonzero(total[span:] - total[:-span] >= least) if len(hit) >= span else np.zeros(0, np.int64)
            a = a[(row[a] == row[a + span - 1]) & (n_words[row[a]] >= length)]
        a = a[total[a + span] - total[a] >= least]
        yield a, a + span, np.full(len(a), length)


def leaks(data: np.ndarray, offsets: np.ndarray, index: ItemIndex, k: int) -> list[tuple]:
    """(row, item, similarity, distance, first word, word after the last) of the best window of each pair."""
    words = words_of(data, offsets)
    row, h = words.shingles(k)
    if not len(h) or not len(index.known):
        return []
    at = np.minimum(np.searchsorted(index.known, h), len(index.known) - 1)
    hit = index.known[at] == h
    if not hit.any():
        return []
    start, stop, length = (np.concatenate(x) for x in zip(*_candidates(words, row, hit, index, k), strict=True))
    order = np.argsort(start, kind="stable")
    start, stop, length = start[order], stop[order], length[order]
    first = np.searchsorted(row, np.arange(words.n_rows + 1))
    best: dict[tuple, tuple] = {}
    lo = 0
    while lo < len(start):
        hi = min(int(np.searchsorted(start, start[lo] + SPAN)), lo + WINDOWS)
        base, end = start[lo], stop[lo:hi].max()
        prints = fingerprints(h[base:end], start[lo:hi] - base, stop[lo:hi] - base)
        window, item, distance = index.lookup(length[lo:hi], prints)
        for w, i, d in sorted(zip(window.tolist(), item.tolist(), distance.tolist(), strict=True), key=lambda x: x[2]):
            a, b = int(start[lo + w]), int(stop[lo + w])
            key = (int(row[a]), i)
            old = best.get(key)
            if old and old[0] == 1.0:
                continue
            score = weighted_similarity(np.sort(h[a:b]), index.sets[i])
            if score >= index.threshold and (not old or (-score, a) < (-old[0], old[2])):
                best[key] = (score, d, a, int(length[lo + w]))
        lo = hi
    for r, i in index.sharing(row[hit], at[hit]):
        if (r, i) in best or index.length[i] < k:
            continue
        own = h[first[r]:first[r + 1]]
        found = index.best_window(own, i)
        if found:
            score, a, b = found
            mark = fingerprints(own[a:b], np.array([0]), np.array([b - a]))[0]
            best[r, i] = (score, int(np.bitwise_count(mark ^ index.prints[i]).sum()), a + int(first[r]), b - a + k - 1)
    return [(r, i, s, d, a - int(first[r]), a - int(first[r]) + n) for (r, i), (s, d, a, n) in sorted(best.items())]


def weighted_similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Shared members of two sorted multisets, weighted by their counts, over the weight of both."""
    values, cx = np.unique(x, return_counts=True)
    other, cy = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(values, other, assume_unique=True, return_indices=True)
    shared = int(np.minimum(cx[i], cy[j]).sum())
    return shared / (len(x) + len(y) - shared)


def _index(texts: list[bytes], k: int, threshold: float) -> ItemIndex:
    key = (hash(tuple(texts)), k, threshold)
    if key not in _index_cache:  # a worker builds the index of a block once
        _index_cache.clear()
        _index_cache[key] = ItemIndex(texts, k, threshold)
    return _index_cache[key]


def _finder(ids: list, kind: pa.DataType, texts: list[bytes], k: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(texts, k, threshold)
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                found = leaks(data, offsets, index, k)
                cols = list(zip(*found, strict=True)) if found else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([lo + r for r in cols[0]], type=pa.int64())),
                     pa.array([ids[i] for i in cols[1]], type=kind), pa.array(cols[2], type=pa.float64()),
                     *[pa.array(c, type=pa.int64()) for c in cols[3:]]],
                    names=["id", "item_id", "similarity", "distance", "word_from", "word_to"])
    return run


def _dropper(at: int, texts: list[bytes], k: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(texts, k, threshold)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for lo, _, data, offsets in blocks(batch.column(at)):
                keep[[lo + x[0] for x in leaks(data, offsets, index, k)]] = False
            yield batch.filter(pa.array(keep))
    return run


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list[bytes]]]:
    """The items in blocks of bounded count and bytes (a longer item is a block of its own)."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")) \
        .where("text is not null").toLocalIterator()
    for r in rows:
        text = r["text"].encode()
        if ids and (len(ids) == ITEMS_PER_BLOCK or size + len(text) > BYTES_PER_BLOCK):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["item"])
        texts.append(text)
        size += len(text)
    if ids:
        yield ids, texts


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per (document, item) that match: similarity, Hamming distance and words of the best window."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType
    schema = (f"id {kind}, item_id {item_type.simpleString()}, similarity double, distance long, "
              "word_from long, word_to long")
    out = None
    for ids, texts in item_blocks(benchmark, item_col, text_col):
        part = source.mapInArrow(_finder(ids, to_arrow_type(item_type), texts, shingle, threshold), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8,
                      text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The documents, all columns, without those that hold an item (a filter in place: no join, no shuffle)."""
    text_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    for _, texts in item_blocks(benchmark, item_col, "text"):
        docs = docs.mapInArrow(_dropper(at, texts, shingle, threshold), docs.schema)
    return docs
