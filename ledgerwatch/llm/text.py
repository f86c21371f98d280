"""Vectorised word handling on Arrow string batches.

Python operators receive text through ``mapInArrow`` and work on the UTF-8
bytes of a whole batch with numpy; no Python string per word is made. A batch
is cut into blocks of about ``BLOCK_BYTES`` so that the arrays of one block
stay bounded (one row is never cut: a very long text is a block of its own).
Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD_KIND = (~_SEP).astype(np.uint8)
_LETTER_KIND = np.zeros(256, dtype=np.uint8)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _LETTER_KIND[_lo:_hi] = 1
_TOKEN_KIND = np.where(_LETTER_KIND > 0, 1, np.where(_SEP, 0, 2)).astype(np.uint8)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply rounds) over uint64 values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..n-1 (kept between batches)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, dtype=np.uint64))))
                          for b in (_BASE, _INV)]
    return _powers[0], _powers[1]


class Words:
    """The words of a block of texts: byte spans, owning row, 64-bit hash.

    ``first[i]:first[i + 1]`` are the words of row i.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.offsets, self.start, self.end = data, offsets, start, end
        self.first = np.searchsorted(start, offsets).astype(np.int64)
        self.n_rows = len(offsets) - 1
        self._hash = self._sums = None

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.first))

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self._hashes(self.end)
        return self._hash

    def prefix_hash(self, n: int) -> np.ndarray:
        """Hash of the first n bytes of every word (of the whole word if shorter)."""
        return self._hashes(np.minimum(self.end, self.start + n))

    def _hashes(self, end: np.ndarray) -> np.ndarray:
        fwd, inv = _power_tables(len(self.data) + 1)
        with np.errstate(over="ignore"):
            if self._sums is None:
                self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
                np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * fwd[:len(self.data)], out=self._sums[1:])
            return mix((self._sums[end] - self._sums[self.start]) * inv[self.start])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every k-word shingle, in order; a row with fewer words
        has its whole word sequence as one shingle, a row without words none."""
        n = np.diff(self.first)
        lens = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
        row = np.repeat(np.arange(self.n_rows), lens)
        ends = np.cumsum(lens)
        at = np.arange(len(row)) - np.repeat(ends - lens, lens) + self.first[:-1][row]
        h = self.hash
        last = self.first[1:][row]
        out = np.zeros(len(row), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                pos = at + j
                inside = pos < last
                w = h[np.minimum(pos, max(len(h) - 1, 0))] if len(h) else out
                out = np.where(inside, mix(out * np.uint64(3) + w, j + 1), out)
        return row, out


def spans(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, lower: bool) -> Words:
    """Maximal runs of bytes of one kind (0: separators, left out), optionally with A-Z lower-cased.
    Runs end where a row ends."""
    kind = kinds[data]
    if lower:
        data = _LOWER[data]
    change = np.ones(len(data) + 1, dtype=bool)  # a run may begin at i, or end before i
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    if len(data) == 0:
        return Words(data, offsets, edges[:0], edges[:0])
    start, end = edges[:-1], edges[1:]
    real = kind[start] > 0
    return Words(data, offsets, start[real], end[real])


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words are maximal runs of bytes other than space and 0x09-0x0D."""
    return spans(data, offsets, _WORD_KIND, lower)


def letters_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased runs of letters, digits and non-ASCII bytes; all else separates."""
    return spans(data, offsets, _LETTER_KIND, True)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of letters, digits and non-ASCII bytes, and runs of other marks, case kept."""
    return spans(data, offsets, _TOKEN_KIND, False)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive row blocks of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if not n:
        return
    _, off, buf = column.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def ragged(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's run in values sorted by row."""
    return np.searchsorted(row, np.arange(n_rows + 1)).astype(np.int64)


def as_binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """One binary cell per row from a flat array and its row offsets."""
    raw = np.ascontiguousarray(values)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first) - 1,
        [None, pa.py_buffer((first * raw.itemsize).astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
