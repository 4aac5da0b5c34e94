"""Token ids of whole texts by a tokenizers file, with a per-worker memo of pieces.

Both tokenizer files used here first split a text into stretches (words with the space
before them, runs of marks, blanks) and then encode each stretch by itself.  A batch of texts is
cut as bytes at places that are sure to be such borders (``_cuts``), each distinct piece is
encoded once by the library, and the ids of a text are the ids of its pieces in a row.
Elsewhere no cut is made, so unusual text makes longer pieces, not other ids.
Texts with ``<|`` (it may open a special token) are encoded whole.

Sure borders, by the files' split patterns, which look ahead only past blanks:
before a space that a letter or visible ASCII mark follows; between a letter and a
following ASCII non-letter; between an ASCII mark or digit (no apostrophe), or a single
blank after a visible character, and a following letter.  Letters here are A-Z, a-z and
the two-byte letters from U+00C0 to U+024F.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from revlens.llm.textops import _BYTE, _tables, mix, segment_ranges, text_chunks

#: pieces kept by a worker (about 40 bytes each); beyond that the memo starts anew
MEMO = 3_000_000

_U = np.uint64
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xCA] = True
_PLAIN_MARK = _VISIBLE & ~_ASCII_LETTER
_PLAIN_MARK[ord("'")] = False


def _cuts(d: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Piece starts in a batch of texts; every text with bytes starts a piece."""
    n = len(d)
    start = np.zeros(n, bool)
    if n > 1:
        lead = _LEAD[d]
        # the two signs among the two-byte letters (U+00D7, U+00F7) are no letters
        two = lead[:-1] & ~((d[:-1] == 0xC3) & ((d[1:] == 0x97) | (d[1:] == 0xB7)))
        first = _ASCII_LETTER[d]
        last = first.copy()
        first[:-1] |= two
        last[1:] |= two
        visible = _VISIBLE[d]
        start[:-1] |= (d[:-1] == 0x20) & (visible[1:] | first[1:])
        start[1:] |= last[:-1] & (d[1:] < 0x80) & ~_ASCII_LETTER[d[1:]] & (d[1:] != 0x20)
        start[1:] |= _PLAIN_MARK[d[:-1]] & first[1:]
        if n > 2:
            blank = (d[1:-1] >= 0x09) & (d[1:-1] <= 0x0D)
            start[2:] |= blank & (visible[:-2] | last[:-2]) & first[2:]
    own = offs[:-1][offs[:-1] < offs[1:]]
    start[own] = True
    return np.flatnonzero(start)


class Encoder:
    """``batches(column)`` yields ``(first row, row after last, ids, id offsets)``; ids are without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, _U)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((x for ids in got for x in ids), np.uint32, int(size.sum())), size

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Add new pieces; ``keys`` ascending."""
        for i in range(0, len(pieces), 20_000):
            ids, size = self._raw(pieces[i:i + 20_000])
            at = len(self.ids) + np.cumsum(size) - size
            where = np.searchsorted(self.keys, keys[i:i + 20_000])
            self.keys = np.insert(self.keys, where, keys[i:i + 20_000])
            self.at, self.size = np.insert(self.at, where, at), np.insert(self.size, where, size)
            self.ids = np.concatenate([self.ids, ids])

    def batches(self, col: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for i, j, d, offs in text_chunks(col, limit):
            n = len(d)
            if not n:
                yield i, j, np.zeros(0, np.uint32), np.zeros(j - i + 1, np.int64)
                continue
            start = _cuts(d, offs)
            end = np.r_[start[1:], n]
            pw, inv = _tables(n + 1)
            total = np.zeros(n + 1, _U)
            np.cumsum(_BYTE[d] * pw[:n], out=total[1:])
            h = mix((total[end] - total[start]) * inv[start])
            del total
            keys, first, of = np.unique(h, return_index=True, return_inverse=True)
            slot = np.searchsorted(self.keys, keys)
            new = np.ones(len(keys), bool)
            inside = slot < len(self.keys)
            new[inside] = self.keys[slot[inside]] != keys[inside]
            if new.any():
                if len(self.keys) + int(new.sum()) > MEMO:
                    self._reset()
                    new[:] = True
                raw = d.tobytes()
                self._learn(keys[new], [raw[a:b].decode("utf-8", "replace") for a, b in
                                        zip(start[first[new]].tolist(), end[first[new]].tolist())])
                slot = np.searchsorted(self.keys, keys)
            at, size = self.at[slot][of], self.size[slot][of]
            ids = self.ids[segment_ranges(at, size)]
            ends = np.r_[0, np.cumsum(size)]
            bounds = ends[np.searchsorted(start, offs)]
            yield i, j, *self._whole(d, offs, ids, bounds)

    def _whole(self, d: np.ndarray, offs: np.ndarray, ids: np.ndarray, bounds: np.ndarray):
        """Texts that may hold a special token, encoded anew as they are."""
        odd = np.flatnonzero((d[:-1] == ord("<")) & (d[1:] == ord("|"))) if len(d) > 1 else []
        if not len(odd):
            return ids, bounds
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for r in np.unique(np.searchsorted(offs, odd, "right") - 1):
            parts[r] = self._raw([d[offs[r]:offs[r + 1]].tobytes().decode("utf-8", "replace")])[0]
        return np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file (loaded once per Python worker)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
