"""Token hashes shared by operators that work on whole texts in Arrow batches."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import xxhash

#: Different tokens a worker remembers; the memory it takes is bounded, the results don't depend on it.
REMEMBER = 1 << 18
#: Texts of a batch that are Python objects at a time.
TEXTS = 256
PUNCTUATION = string.punctuation + "«»“”„‘’…–—¿¡"


def each(column: pa.Array) -> Iterator[str | bytes | None]:
    """The values of a column one by one; only ``TEXTS`` of them are held besides the batch."""
    for at in range(0, len(column), TEXTS):
        yield from column.slice(at, TEXTS).to_pylist()


@cache
def _trim() -> Callable[[int], int] | None:
    """glibc's malloc_trim; other libraries give memory back by themselves or not at all."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, but a worker that waits for its next task doesn't keep the memory of this one."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


class Remember(dict):
    """``token -> make(token)``, forgetting everything when it holds ``REMEMBER`` tokens."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, token):
        if len(self) >= REMEMBER:
            self.clear()
        self[token] = out = self.make(token)
        return out


def plain_hash(token: bytes) -> int:
    """64-bit hash of a token without case and outer punctuation; 0 if nothing is left."""
    word = token.decode("utf-8", "replace").lower().strip(PUNCTUATION)
    return xxhash.xxh64_intdigest(word.encode()) or 1 if word else 0
