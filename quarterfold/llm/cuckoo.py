"""Cuckoo filter in numpy: membership of 64-bit hashes with insertion and deletion, many at a time.

A segment is a table of buckets with SLOTS fingerprints each; 0 is a free slot. A hash has a fingerprint and two
buckets, either of which gives the other. When a segment is full another of the same shape is opened. As all
have one shape, a hash has the same fingerprint and buckets in each, so equal fingerprints may stand for each other
and a deletion may take any of them.
"""

from __future__ import annotations

import numpy as np

from quarterfold.llm.wordhash import mixed

SLOTS = 4
LOAD = 0.9  # share of its slots that a segment is filled to
PRINT = 0xFFFFFFFF  # bits of a fingerprint
KICKS = 64  # rounds of moving fingerprints about before a new segment is opened


class Cuckoo:
    def __init__(self, buckets: int, data: bytes = b""):
        if buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self.buckets = buckets
        found = np.frombuffer(data, dtype=np.uint32).reshape(-1, buckets, SLOTS)
        self.segments = [s.copy() for s in found] or [self._empty()]
        self.kicks = np.random.default_rng(len(data))

    def _empty(self) -> np.ndarray:
        return np.zeros((self.buckets, SLOTS), dtype=np.uint32)

    def to_bytes(self) -> bytes:
        return np.concatenate(self.segments).tobytes()

    def _of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint, never 0, and first bucket."""
        m = mixed(hashes.astype(np.uint64, copy=False))
        prints = ((m >> np.uint64(32)) & np.uint64(PRINT)).astype(np.uint32)
        return np.where(prints == 0, np.uint32(1), prints), (m & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (mixed(prints.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, at = self._of(hashes)
        other, found = self._other(prints, at), np.zeros(len(hashes), dtype=bool)
        for s in self.segments:
            found |= (s[at] == prints[:, None]).any(axis=1) | (s[other] == prints[:, None]).any(axis=1)
        return found

    def insert(self, hashes: np.ndarray) -> None:
        """One fingerprint for each hash given, also for one that is there."""
        prints, at = self._of(hashes)
        while len(prints):
            s = self.segments[-1]
            room = int(LOAD * s.size) - int(np.count_nonzero(s))
            if room > 0:
                left = self._placed(s, prints[:room], at[:room])
                prints, at = (np.concatenate([a, b[room:]]) for a, b in zip(left, (prints, at), strict=True))
            if len(prints):
                self.segments.append(self._empty())

    def _placed(self, s: np.ndarray, prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts fingerprints into a segment; returns those left over, each with one of its buckets."""
        tried = np.zeros(len(prints), dtype=np.int64)
        for _ in range(KICKS * SLOTS):
            if not len(prints):
                break
            _, now = np.unique(at, return_index=True)  # one a bucket at a time
            slots = s[at[now]]
            free = slots == 0
            fits = free.any(axis=1)
            into = np.where(fits, free.argmax(axis=1), self.kicks.integers(0, SLOTS, len(now)))
            kick = ~fits & (tried[now] > 0)  # both buckets were full
            put = fits | kick
            out = s[at[now], into]
            s[at[now][put], into[put]] = prints[now][put]
            prints[now[kick]] = out[kick]
            move = now[~fits]
            at[move] = self._other(prints[move], at[move])
            tried[move] += 1
            tried[now[kick]] = 1  # its other bucket is next
            stay = np.ones(len(prints), dtype=bool)
            stay[now[fits]] = False
            prints, at, tried = prints[stay], at[stay], tried[stay]
        return prints, at

    def delete(self, hashes: np.ndarray) -> None:
        """Takes one fingerprint away for each hash, all of which must have been inserted."""
        prints, at = self._of(hashes)
        for s in self.segments:
            for look in range(2):
                left = np.ones(len(prints), dtype=bool)
                todo = np.arange(len(prints))
                where = at if look == 0 else self._other(prints, at)
                while len(todo):
                    _, first = np.unique(where[todo], return_index=True)
                    now = todo[first]
                    match = s[where[now]] == prints[now][:, None]
                    hit = match.any(axis=1)
                    s[where[now[hit]], match[hit].argmax(axis=1)] = 0
                    left[now[hit]] = False
                    todo = np.delete(todo, first)
                prints, at = prints[left], at[left]
        if len(prints):
            raise ValueError(f"{len(prints)} hashes were not in the filter")
