"""Token ids of whole Arrow text blocks with a public byte-level BPE vocabulary.

The vocabulary's pre-tokenisation never lets a match run across a single space
that follows a character other than white space. Texts are therefore cut there
into pieces; the pieces of a block are told apart by two vectorised hashes,
each different piece is encoded once, and its ids are dealt back to all its
places. The result equals encoding the whole text.
"""

from __future__ import annotations

import base64

import numpy as np
import tiktoken

from ledgerwatch.llm.text import Words, mix

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256        # the vocabulary's free id: end of document
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STORE = 400_000    # pieces kept between blocks
_loaded: dict[str, Encoder] = {}


def pieces(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Spans that tile each text, cut before every space that follows a character surely not white space."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 3:
        space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        cut[1:n] = (data[1:] == 0x20) & ~space[:-1]
        # white space beyond ASCII is C2 xx or a three-byte character led by E1, E2 or E3
        cut[2:n] &= data[:-2] != 0xC2
        cut[3:n] &= (data[:-3] < 0xE1) | (data[:-3] > 0xE3)
    else:
        cut[:] = False
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    live = edges[:-1] < edges[1:]
    return Words(data, offsets, edges[:-1][live], edges[1:][live])


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.store: dict[bytes, list[int]] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint16, row offsets) of a block of texts."""
        p = pieces(data, offsets)
        if not len(p.start):
            return np.zeros(0, dtype=np.uint16), np.zeros(len(offsets), dtype=np.int64)
        _, where, code = np.unique(p.hash, return_index=True, return_inverse=True)
        # a second hash (of the piece less its first byte, and its length) must agree with the first one's groups
        second = mix(p._hashes(p.end - 1) ^ (p.end - p.start).astype(np.uint64), 5)
        if (second[where][code] != second).any():
            return self._row_by_row(data, offsets)
        if len(self.store) > STORE:
            self.store.clear()
        raw, store, encode = data.tobytes(), self.store, self.bpe.encode_ordinary
        flat: list[int] = []
        size = np.empty(len(where), dtype=np.int64)
        for i, (a, b) in enumerate(zip(p.start[where].tolist(), p.end[where].tolist(), strict=True)):
            piece = raw[a:b]
            ids = store.get(piece)
            if ids is None:
                ids = store[piece] = encode(piece.decode())
            flat += ids
            size[i] = len(ids)
        flat_ids = np.array(flat, dtype=np.uint16)
        begin = np.cumsum(size) - size
        n = size[code]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(begin[code] - (ends - n), n)
        return flat_ids[at], np.concatenate(([0], ends))[p.first]

    def _row_by_row(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        rows = [self.bpe.encode_ordinary(raw[a:b].decode()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return (np.array([t for r in rows for t in r], dtype=np.uint16),
                np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64))


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def with_ends(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row's ids followed by the end-of-document id."""
    return np.insert(ids, first[1:], np.uint16(END)), first + np.arange(len(first))
