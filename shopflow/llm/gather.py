"""Numpy helpers for token work inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BATCH_CHARS = 1 << 20


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges [start, start + length)."""
    total = int(length.sum())
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(total)


class Segments:
    """A bounded cache from a piece of text to its ids, kept in one flat
    array.  ``encode_new`` encodes a list of unseen keys at once."""

    def __init__(self, encode_new: Callable[[list], tuple[np.ndarray, np.ndarray]],
                 entries: int = 400_000, ids: int = 4_000_000):
        self.encode_new, self.entries, self.max_ids = encode_new, entries, ids
        self._reset()

    def _reset(self) -> None:
        self.index: dict = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        self.used = 0

    def ids(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all keys, concatenated, and their number per key."""
        if len(self.index) > self.entries or self.used > self.max_ids:
            self._reset()
        at = list(map(self.index.get, keys))
        new = list(dict.fromkeys(k for k, i in zip(keys, at, strict=True) if i is None))
        if new:
            flat, lens = self.encode_new(new)
            n0, n1 = len(self.index), len(self.index) + len(new)
            self.flat = _room(self.flat, self.used + len(flat))
            self.start, self.length = _room(self.start, n1), _room(self.length, n1)
            self.flat[self.used:self.used + len(flat)] = flat
            self.length[n0:n1] = lens
            self.start[n0:n1] = self.used + np.cumsum(lens) - lens
            self.used += len(flat)
            self.index.update(zip(new, range(n0, n1)))
            at = [self.index[k] if i is None else i for k, i in zip(keys, at, strict=True)]
        at = np.array(at, np.int64)
        length = self.length[at]
        return self.flat[ragged(self.start[at], length)], length


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about ``chars`` bytes of text (a
    longer text comes alone)."""
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(text))
        size = np.diff(np.frombuffer(col.buffers()[1], np.int32 if pa.types.is_string(col.type) else np.int64,
                                     count=len(col) + 1, offset=col.offset * 4 if pa.types.is_string(col.type) else col.offset * 8).astype(np.int64))
        group = (np.cumsum(size) - size) // chars
        cuts = np.flatnonzero(np.diff(group)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            yield b.slice(int(lo), int(hi - lo))


def cut(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The non-empty buckets of an ascending array, each with its slice."""
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(edges[b], edges[b + 1])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, each behind its length, as one value for a shuffle."""
    return b"".join(np.int64(len(a)).tobytes() + a.tobytes() for a in arrays)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        n = int(np.frombuffer(blob, np.int64, 1, at)[0])
        out.append(np.frombuffer(blob, t, n, at + 8))
        at += 8 + n * np.dtype(t).itemsize
    return out
