"""Words of Arrow string columns as numpy arrays: where they are, and 64-bit hashes of words and of runs of words.

A word's hash is a polynomial over its bytes, a run's a polynomial over mixed word hashes, both modulo 2**64, each
mixed at the end. Prefix sums give the hash of every run of k words at the cost of a few operations a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute

PIECE = 1 << 20  # bytes of text worked on at a time; a longer text is a piece of its own
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int, inverse: bool = False) -> np.ndarray:
    key = (int(base), inverse)
    if key not in _powers or len(_powers[key]) < n:
        step = np.uint64(pow(int(base), -1, 2**64)) if inverse else base
        p = np.full(max(n, 1), step, dtype=np.uint64)
        p[0] = 1
        if n > 1 << 21:  # not kept: one very long text
            return np.cumprod(p)
        _powers[key] = np.cumprod(p)
    return _powers[key][:n]


@dataclass
class Words:
    """Of some rows: where each word begins and ends in ``data``, its row, and its number in that row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    at: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """For each row the index of its first word."""
        return np.cumsum(self.counts) - self.counts

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        longest = int((self.ends - self.starts).max())
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[self.starts] = 1
        inside[self.ends] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        lengths = self.ends - self.starts
        bytes_ = self.data[inside].astype(np.uint64) + np.uint64(1)
        begin = np.cumsum(lengths) - lengths
        within = np.arange(len(bytes_), dtype=np.int32) - np.repeat(begin.astype(np.int32), lengths)
        return mixed(np.add.reduceat(bytes_ * powers(BASES[0], longest)[within], begin))


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """(first row, rows) of slices whose texts have PIECE bytes at most, or one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > PIECE:
            yield begin, i - begin
            begin, held = i, 0
        held += int(n)
    if len(sizes) > begin:
        yield begin, len(sizes) - begin


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def words(texts: pa.Array) -> Words:
    """Words between ASCII white space; null has none."""
    texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = ~is_space(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(row, minlength=len(texts)).astype(np.int64)
    at = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    return Words(data, starts, ends, row, at, counts)


def runs(hashes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of the k words from each position on; positions that run into the next row are the caller's to leave out."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(BASES[which], n), out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * powers(BASES[which], n - k + 1, inverse=True))
