"""Numpy helpers on the UTF-8 buffers of Arrow string columns.

Words are runs of the bytes 0-9, a-z, A-Z and 0x80-0xFF, hashed with a
polynomial over prefix sums, so a batch of texts is handled by a few array
operations instead of a Python loop over words. Buffers are walked in
pieces of about ``PIECE`` bytes that end between words, which bounds the
scratch memory whatever the length of a text.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True

_powers: dict[int, np.ndarray] = {}


#: Arrays of this size and more are given back as soon as they are freed.
MAPPED = 8 << 20
_M_MMAP_THRESHOLD = -3


def give_back() -> None:
    """Memory that Arrow and the C library keep for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def released(batches):
    """The batches of a task; when they end, memory goes back to the system,
    as a reused Python worker would otherwise hold the peak of every stage it
    has run. Large arrays that live longer are mapped apart, so they go back
    whenever they are freed."""
    try:
        ctypes.CDLL("libc.so.6").mallopt(_M_MMAP_THRESHOLD, MAPPED)
    except (OSError, AttributeError):
        pass  # another C library
    yield from batches
    give_back()


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 1024), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (the public splitmix64 constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (a null is an empty text) and their n + 1 offsets."""
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(at, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    if data is None or last == first:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, last - first, first), offsets - first


def pieces(data: np.ndarray, offsets: np.ndarray):
    """Spans [lo, hi) of the buffer that cut no word of a text."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + PIECE)
        while hi < n and not np.any(offsets == hi):
            ahead = data[hi : hi + PIECE]
            gaps = np.flatnonzero(~WORD_BYTE[ahead])
            nearest = hi + int(gaps[0]) if len(gaps) else hi + len(ahead)
            k = np.searchsorted(offsets, hi)
            if k < len(offsets) and offsets[k] <= nearest:
                nearest = int(offsets[k])
                hi = nearest
                break
            hi = nearest
            if len(gaps):
                break
        yield lo, hi
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...] = ()):
    """For each piece: the text number, the start byte and the hash of every
    word, and for each of ``lengths`` the hash of the word's first so many
    bytes (0 where the word is shorter). Hashes depend on the bytes alone."""
    for lo, hi in pieces(data, offsets):
        part = data[lo:hi]
        inside = WORD_BYTE[part]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "right")] - lo
        at = edges[edges < hi - lo]
        begins[at] = inside[at]
        at = edges[edges > 0] - 1
        closes[at] = inside[at]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        if not len(starts):
            continue
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(part)), out=sums[1:])
        back = powers(_BASE_INVERSE, len(part))[starts]
        low = sums[starts]
        hashes = mix((sums[ends] - low) * back)
        heads = []
        for k in lengths:
            cut = np.minimum(starts + k, ends)
            head = mix((sums[cut] - low) * back + np.uint64(k))
            head[ends - starts < k] = 0
            heads.append(head)
        texts = np.searchsorted(offsets, starts + lo, "right") - 1
        yield texts, starts + lo, hashes, heads


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes in order, and the n + 1 offsets of the texts in them."""
    n = len(offsets) - 1
    found = [(texts, hashes) for texts, _, hashes, _ in words_of(data, offsets)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    texts = np.concatenate([t for t, _ in found])
    counts = np.bincount(texts, minlength=n)
    return np.concatenate([h for _, h in found]), np.concatenate([[0], np.cumsum(counts)])


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words of one text; a shorter text is one run."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + hashes[j : j + n]
    return mix(total)


def occurrences(values: np.ndarray) -> np.ndarray:
    """For each element, how many equal elements come before it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - first
    return out
