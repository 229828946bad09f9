"""Ids of texts from ids of their distinct chunks.

Most chunks (white space and the word after it) of a corpus repeat, so each distinct chunk is encoded once per
Python worker and a text is a gather over a table. Chunks are told apart by 64-bit hashes, so the table holds no text:
per chunk a hash, two places and its ids. It is bounded in chunks and in ids; beyond a limit it starts anew."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .common import prefix_sums, span_hashes


def gathered(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Slices of an array, one after the other."""
    counts = ends - starts
    total = int(counts.sum())
    if not total:
        return values[:0]
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    at += np.arange(total)
    return values[at]


class ChunkIds:
    """``encode(chunks) -> (chunks, ids, counts)`` gives the ids of many different chunks (bytes), joined, and how many
    each has; it may put the chunks into another order. At most ``limit`` chunks and eight times as many ids are kept
    from one call to the next."""

    def __init__(self, encode: Callable, limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.start = np.zeros(0, np.int64)
        self.end = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        """Adds chunks, given in ascending order of their hashes."""
        listed, ids, counts = self.encode(chunks)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(ids), len(self.ids)), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        ends = self.used + np.cumsum(counts)
        self.used += len(ids)
        if listed is not chunks:
            place = dict(zip(listed, range(len(listed))))
            order = np.fromiter(map(place.__getitem__, chunks), np.int64, len(chunks))
            ends, counts = ends[order], counts[order]
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.start, self.end = np.insert(self.start, at, ends - counts), np.insert(self.end, at, ends)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in a row, and how many ids each chunk has."""
        hashes, first, inverse = np.unique(span_hashes(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
        if self.used > 8 * self.limit:
            self._clear()
        known = np.zeros(len(hashes), bool)
        if len(self.hashes):
            known = self.hashes[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)] == hashes
        if len(self.hashes) + len(hashes) - int(known.sum()) > self.limit:
            self._clear()
            known[:] = False
        new = np.flatnonzero(~known)
        if len(new):
            held = data.tobytes()
            self._learn(hashes[new], [held[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
        codes = np.searchsorted(self.hashes, hashes)[inverse]
        lo, hi = self.start[codes], self.end[codes]
        return gathered(self.ids, lo, hi), hi - lo
