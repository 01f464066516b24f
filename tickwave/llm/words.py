"""Vectorised word tables over Arrow string columns (runs inside Spark tasks).

A batch of texts is one UTF-8 byte buffer plus offsets, so words, lines,
hashes and shingles of many documents are found with numpy over that buffer
instead of one Python call per document.  All separators are ASCII, so working
on UTF-8 bytes is exact.  Callers cut batches with :func:`slices`, which bounds
the temporaries (about 40 bytes per text byte) by the slice size or, for one
very long text, by that text.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_RNG = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITION = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps)
    return have


def give_back() -> None:
    """Free memory that this worker process keeps for itself goes back to the
    system: workers live on between tasks and share the executor's memory."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


#: What worker processes keep between tasks for the next ones of one operator,
#: by its name: the function that drops it.
KEPT: dict = {}


def trimmed(run, keeps: str = ""):
    """``run`` for mapInArrow, with :func:`give_back` at the end of each task.  Only
    what the operator ``keeps`` is kept from earlier tasks: a worker that turns to
    other work first drops what the last one left, so their memory doesn't add up."""
    def whole(batches):
        others = [drop for name, drop in KEPT.items() if name != keeps]
        for drop in others:
            drop()
        if others:
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Texts:
    """Bytes of consecutive texts; text i is ``data[offset[i]:offset[i + 1]]``."""

    data: np.ndarray
    offset: np.ndarray

    def __len__(self) -> int:
        return len(self.offset) - 1

    def count(self, member: np.ndarray) -> np.ndarray:
        """Per text, the number of bytes b with ``member[b]``."""
        total = np.concatenate(([0], np.cumsum(member[self.data], dtype=np.int64)))
        return np.diff(total[self.offset])


@dataclass
class Runs:
    """Maximal runs of non-separator bytes: text index, byte start and end."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.doc)


def texts_of(column: pa.Array) -> Texts:
    """A string column as bytes; a null text is empty."""
    a = column.cast(pa.large_binary())
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    if a.null_count:
        a = a.fill_null(b"")
    offset = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    if not len(a):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    body = a.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return Texts(data[offset[0]:offset[-1]], offset - offset[0])


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(low, high) row ranges of at most ``limit`` bytes, at least one row each."""
    offset = texts_of(column).offset
    low, n = 0, len(offset) - 1
    while low < n:
        high = int(np.searchsorted(offset, offset[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


def runs(t: Texts, separators: np.ndarray) -> Runs:
    inside = ~separators[t.data]
    if not len(inside):
        e = np.zeros(0, np.int64)
        return Runs(e, e, e)
    full = t.offset[:-1][np.diff(t.offset) > 0]
    before = np.concatenate(([False], inside[:-1]))
    before[full] = False
    after = np.concatenate((inside[1:], [False]))
    after[full[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Runs(np.searchsorted(t.offset, start, "right") - 1, start, end)


def hashes(t: Texts, r: Runs) -> np.ndarray:
    """64-bit hash of each run's bytes (polynomial over random byte values,
    made independent of the position, then finalized with the length)."""
    n = len(t.data)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[t.data] * _powers(_BASE, n + 1)[:n], out=total[1:])
    h = (total[r.end] - total[r.start]) * _powers(_INVERSE, n + 1)[r.start]
    return mix(h + (r.end - r.start).astype(np.uint64) * _POSITION[0])


def first_and_count(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(doc, minlength=n_docs)
    return np.concatenate(([0], np.cumsum(n)[:-1])), n


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of every window of k words; a text of 1 to k-1 words gives
    its whole word sequence as one shingle."""
    first, n = first_and_count(doc, n_docs)
    m = len(h) - k + 1
    if m > 0:
        ok = np.flatnonzero(doc[:m] == doc[k - 1:])
        full = np.zeros(len(ok), np.uint64)
        for j in range(k):
            full += h[ok + j] * _POSITION[j + 1]
    else:
        ok, full = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < k))
    part = n[short].astype(np.uint64) * _POSITION[k + 1]
    for j in range(k - 1):
        has = n[short] > j
        part[has] += h[first[short[has]] + j] * _POSITION[j + 1]
    return mix(np.concatenate((full, part))), np.concatenate((doc[ok], short))


def distinct_by_doc(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, hash) pairs, sorted by doc and then hash."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if not len(h):
        return h, doc
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
    return h[new], doc[new]
