"""Numpy helpers the operators share inside tasks: texts as one byte buffer,
words, and 64-bit hashes of arbitrary byte spans in constant time each.

A batch of texts becomes one ``uint8`` buffer in which a space follows every
text, so no word or span of interest crosses two texts unnoticed. Span hashes
are differences of a prefix sum ``sum(R[byte] * B**i)`` modulo 2**64, shifted
back by the inverse power and mixed; ``R`` is a fixed random table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

BASE = 0x9E3779B97F4A7C15
_INV = pow(BASE, -1, 2 ** 64)
TABLE = np.random.default_rng(20240607).integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Texts are worked on in slices of about this many bytes (a longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**i`` and ``B**-i`` for i < n (kept between calls up to 4 Mi entries)."""
    global _pow, _inv
    if len(_pow) >= n:
        return _pow[:n], _inv[:n]
    m = max(n, SLICE_BYTES * 2)
    p, q = np.full(m, BASE, np.uint64), np.full(m, _INV, np.uint64)
    p[0] = q[0] = 1
    np.cumprod(p, out=p)
    np.cumprod(q, out=q)
    if m <= 1 << 22:
        _pow, _inv = p, q
    return p[:n], q[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(32))  # a new array, changed in place from here on
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums that :func:`span_hash` takes differences of."""
    p, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(TABLE[buf] * p[:-1], out=out[1:])
    return out


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``buf[start:end]`` for arrays of spans."""
    _, q = powers(len(h))
    return mix((h[end] - h[start]) * q[start])


def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(BASE) + b)


def text_slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts sum to about ``max_bytes``."""
    if len(texts) == 0:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(sizes):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + max_bytes, side="right")))
        yield at, end
        at = end


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a space after each text, starts, ends); a null text is empty."""
    arr = pc.fill_null(texts, "").cast(pa.large_binary())
    n = len(arr)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), z, z
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    ends = off[1:] + np.arange(n)
    starts = off[:-1] + np.arange(n)
    out = np.empty(len(raw) + n, np.uint8)
    gap = np.zeros(len(out), bool)
    gap[ends] = True
    out[gap] = 32
    out[~gap] = raw
    return out, starts, ends


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without space and \\t to \\r."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z
    edge = np.diff(SPACE[buf].astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def window_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n word hashes (length len - n + 1; empty if fewer)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - n + 1]
    for i in range(1, n):
        out = fold(out, words[i:len(words) - n + 1 + i])
    return out


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start index of each run of equal values."""
    if len(sorted_values) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def squeeze(*arrays: np.ndarray) -> bytes:
    """Integer or float arrays as compressed byte planes."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([len(a), ord(a.dtype.kind), a.dtype.itemsize], "<i8").tobytes())
        parts.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def expand(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, kind, width = np.frombuffer(raw, "<i8", 3, at)
        planes = np.frombuffer(raw, np.uint8, int(n * width), at + 24).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(np.dtype(f"{chr(kind)}{width}")).ravel())
        at += 24 + int(n * width)
    return out


def steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=np.uint64(0))
