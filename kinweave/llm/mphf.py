"""Minimal perfect hash over distinct 128-bit line hashes, with payload arrays.

Levels of bit arrays as in the published collision-resolution-by-levels construction: a key
takes the first level where no other key shares its position; the rank of that bit is its
index. Keys that no level separates (equal first halves) are kept in a plain list.
"""

from __future__ import annotations

import io

import numpy as np

GAMMA, LEVELS = 2.0, 24


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class LineIndex:
    """``lookup`` gives the count and the largest document of each member, count 0 for others."""

    def __init__(self, words, ranks, sizes, prints, counts, largest, rest):
        self.words, self.ranks, self.sizes = words, ranks, sizes
        self.prints, self.counts, self.largest, self.rest = prints, counts, largest, rest

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, largest: np.ndarray) -> LineIndex:
        """Over distinct (h1, h2); ``h2`` is kept as the fingerprint."""
        h1, h2 = np.asarray(h1).view(np.uint64), np.asarray(h2).view(np.uint64)
        left, words, sizes, owner, base = np.arange(len(h1)), [], [], [], 0
        for level in range(LEVELS):
            if not len(left):
                break
            size = (max(64, int(GAMMA * len(left))) + 63) // 64 * 64
            at = (_mix(h1[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            owner.append(np.stack([at[alone] + base, left[alone]]))
            sizes.append(size)
            base += size
            left = left[~alone]
        words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        order = np.concatenate(owner, axis=1) if owner else np.zeros((2, 0), np.int64)
        order = order[1][np.argsort(order[0])]
        rest = np.stack([h1[left], h2[left], np.asarray(counts)[left].astype(np.uint64), np.asarray(largest)[left].view(np.uint64)])
        return cls(words, ranks, np.array(sizes, np.int64), h2[order], np.asarray(counts)[order], np.asarray(largest)[order], rest)

    def lookup(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h1, h2 = np.asarray(h1).view(np.uint64), np.asarray(h2).view(np.uint64)
        slot, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = (_mix(h1[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            slot[left[hit]] = self.ranks[at[hit] >> 6] + below
            left = left[~hit]
            base += int(size)
        counts, largest = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        sure = np.flatnonzero(slot >= 0)
        sure = sure[self.prints[slot[sure]] == h2[sure]]
        counts[sure], largest[sure] = self.counts[slot[sure]], self.largest[slot[sure]]
        for a, b, n, doc in self.rest.T:
            same = (h1 == a) & (h2 == b)
            counts[same], largest[same] = int(n), int(np.uint64(doc).astype(np.int64))
        return counts, largest

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, words=self.words, ranks=self.ranks, sizes=self.sizes, prints=self.prints, counts=self.counts, largest=self.largest, rest=self.rest)
        return out.getvalue()

    @classmethod
    def loads(cls, blob: bytes) -> LineIndex:
        with np.load(io.BytesIO(blob)) as f:
            return cls(*(f[k] for k in ("words", "ranks", "sizes", "prints", "counts", "largest", "rest")))
