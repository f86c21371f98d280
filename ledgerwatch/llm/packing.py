"""Token packing by best-fit decreasing with a segment tree over remaining capacities.

Tasks tokenise their documents and pack windows of ``WINDOW_TOKENS`` tokens:
memory is bounded whatever the partition, nothing is shuffled, and a window of
some thousand documents fills its rows almost completely. Longer documents
than a row are split into full rows and a tail without losing a token.

A packed row holds the ids of its segments and padding (uint16, little
endian), cumulative segment lengths, the places where positions restart at 0,
and for every segment its document and token offset in it.

Defined cases: every document ends in the end-of-document id, null and empty
texts are that id alone; rows with null ids and repeated rows are packed like
any other; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.spread import text_batches
from ledgerwatch.llm.text import blocks
from ledgerwatch.llm.tokens import END, VOCABULARY, encoder, with_ends

ROW_TOKENS = 2048
WINDOW_TOKENS = 4 << 20
SCHEMA = ("part int, row long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "{id}s array<{kind}>, token_offsets array<long>")


class Capacities:
    """Open bins by remaining capacity; a segment tree finds the least capacity that suffices."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def _count(self, at: int, by: int) -> None:
        at += self.size
        while at:
            self.tree[at] += by
            at >>= 1

    def add(self, capacity: int, bin_no: int) -> None:
        self.bins[capacity].append(bin_no)
        self._count(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(bin, capacity) of the fullest bin that has room for ``least``, removed."""
        at, tree = least + self.size, self.tree
        while not tree[at]:            # up, to the first subtree on the right that holds a bin
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
            if at & (at - 1) == 0:     # past the right end of this level
                return None
        while at < self.size:          # down to its least capacity
            at = 2 * at if tree[2 * at] else 2 * at + 1
        capacity = at - self.size
        self._count(capacity, -1)
        return self.bins[capacity].pop(), capacity


def best_fit(lengths: np.ndarray, most: int) -> np.ndarray:
    """Bin of each segment (lengths 1..most): longest first, into the fullest bin with room."""
    room, out, n_bins = Capacities(most), np.empty(len(lengths), dtype=np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = room.take(n)
        if found is None:
            found, n_bins = (n_bins, most), n_bins + 1
        out[i] = found[0]
        if found[1] > n:
            room.add(found[1] - n, found[0])
    return out


def segments(first: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, offset in it, length) of every piece of at most ``most`` tokens."""
    n = np.diff(first)
    parts = -(-n // most)
    doc = np.repeat(np.arange(len(n)), parts)
    no = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    return doc, no * most, np.minimum(n[doc] - no * most, most)


def pack(ids: np.ndarray, first: np.ndarray, most: int):
    """(matrix, bin of each segment's row, segment order): packed rows of one window."""
    doc, offset, length = segments(first, most)
    bin_no = best_fit(length, most)
    order = np.lexsort((doc, bin_no))
    doc, offset, length, bin_no = doc[order], offset[order], length[order], bin_no[order]
    n_bins = int(bin_no.max()) + 1 if len(bin_no) else 0
    ends = np.cumsum(length)
    row_first = np.searchsorted(bin_no, np.arange(n_bins + 1))
    before = np.concatenate(([0], ends))[row_first[:-1]]
    place = ends - length - before[bin_no]              # of each segment in its row
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[doc] + offset - (ends - length), length)
    target = np.arange(len(source)) + np.repeat(bin_no * most + place - (ends - length), length)
    matrix = np.full(n_bins * most, END, dtype=np.uint16)
    matrix[target] = ids[source]
    return matrix.reshape(n_bins, most), row_first, doc, offset, length, place


def _packer(path: str, most: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row_no = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal row_no
            keys = pa.concat_arrays([k for k, _, _ in held])
            ids = np.concatenate([x for _, x, _ in held])
            counts = np.concatenate([np.diff(f) for _, _, f in held])
            held.clear()
            matrix, row_first, doc, offset, length, place = pack(ids, np.concatenate(([0], np.cumsum(counts))), most)
            for lo in range(0, len(matrix), 512):
                hi = min(lo + 512, len(matrix))
                a, b = row_first[lo], row_first[hi]
                off = pa.array((row_first[lo:hi + 1] - a).astype(np.int32))
                starts = place[a:b].astype(np.int32)
                used = np.add.reduceat(length[a:b], row_first[lo:hi] - a)
                cu = np.insert(starts, row_first[lo + 1:hi + 1] - a, used.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * (hi - lo), pa.int32()), pa.array(np.arange(row_no + lo, row_no + hi)),
                    pa.array(used.astype(np.int32)), pa.array([r.tobytes() for r in matrix[lo:hi]], pa.binary()),
                    pa.ListArray.from_arrays(pa.array((row_first[lo:hi + 1] - a + np.arange(hi - lo + 1)).astype(np.int32)),
                                             pa.array(cu)),
                    pa.ListArray.from_arrays(off, pa.array(starts)),
                    pa.ListArray.from_arrays(off, keys.take(pa.array(doc[a:b]))),
                    pa.ListArray.from_arrays(off, pa.array(offset[a:b]))], names=names)
            row_no += len(matrix)

        bpe, size = encoder(path), 0
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                ids, first = with_ends(*bpe.encode(data, offsets))
                held.append((batch.column(0).slice(lo, hi - lo), ids, first))
                size += len(ids)
                if size >= WINDOW_TOKENS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()
    return run


def pack_documents(docs: DataFrame, row_tokens: int = ROW_TOKENS, vocabulary: str = VOCABULARY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows; (part, row) names a row."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = SCHEMA.format(id=id_col, kind=source.schema["id"].dataType.simpleString())
    names = [f.split(" ")[0] for f in schema.split(", ")]
    return source.mapInArrow(_packer(vocabulary, row_tokens, names), schema)
