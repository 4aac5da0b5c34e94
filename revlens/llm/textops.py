"""Vectorised word splitting and hashing of UTF-8 columns (numpy, inside Spark tasks).

Both word classes used here are unions of whole code points that can be told
apart byte by byte (every byte of a non-ASCII code point is a word byte), so a
batch of texts is processed as one byte array without decoding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_POS = _rng.integers(1, 2**63, 64, dtype=_U) * _U(2) + _U(1)
_R = int(_rng.integers(1, 2**61)) * 8 + 5
_R_INV = pow(_R, -1, 2**64)

_LOWER = np.arange(256)
_LOWER[65:91] += 32
_HASH_OF_BYTE = _BYTE[_LOWER]

#: ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z (capitals are word bytes here)
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {"pow": np.ones(1, _U), "inv": np.ones(1, _U)}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["pow"]) < n:
        for name, base in (("pow", _R), ("inv", _R_INV)):
            t = np.full(n, base, _U)
            t[0] = 1
            _powers[name] = np.cumprod(t, dtype=_U)
    return _powers["pow"], _powers["inv"]


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after last, bytes, offsets)`` slices of a string column of about ``limit`` bytes; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def words(data: np.ndarray, offs: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) and the word offsets of each text (one more than texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(len(offs), np.int64)
    w = kind[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    edge = offs[:-1]
    before[edge[edge < n]] = False
    start = np.flatnonzero(w & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    end = np.flatnonzero(w & ~after) + 1
    pw, inv = _tables(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(_HASH_OF_BYTE[data] * pw[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inv[start])
    return h, np.searchsorted(start, offs).astype(np.int64)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (positions 0 .. len-k)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.full(n, k, _U)
    for i in range(k):
        out += h[i:n + i] * _POS[i]
    return mix(out)


def segment_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + n)`` over the pairs."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
    return first + np.arange(total)


def pack_planes(a: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed: bytes of like rank stand together, leading zero bytes cost nothing."""
    return zlib.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T), 1)


def unpack_planes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), np.uint8).reshape(size, -1).T).view(dtype).ravel()
