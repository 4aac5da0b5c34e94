"""Hierarchical multi-length packing.

Each scan partition packs its own documents, so nothing is shuffled and a lost task
is simply run again.  Documents are read into a pool of about ``pool_tokens`` ids.
A document longer than the largest tier gives whole windows of that tier; what is
left, and every shorter document, is routed to the smallest tier that holds it.  Tiers
are packed from long to short: a window takes its tier's longest piece, its gap is
filled with the longest pieces of the same or shorter tiers that fit, and when none fits one
is cut to fill the gap exactly.  When too few ids are left for a window, they wait for the
next pool; at the end of the partition they are laid out in windows of
the powers of two that make up their number.  Every window is thus full: nothing is padded.

Windows are balanced over step groups of ``step_tokens`` ids: a window goes to the
open group with most room, so all groups but the partition's last few hold equally many.

Sizes are powers of two.  Rows: a null text is empty; an empty text is its end id
alone.  Null ids, repeated rows and rows that share a doc_id are documents of their own.
An empty table gives no rows.  Only the named id and text columns are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import END_ID
from revlens.llm.encode import encoder

TIERS = (512, 1024, 2048, 4096)
PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long")


class Packer:
    """Packs one partition; ``take`` and ``close`` yield finished pieces as tuples in the order of ``PIECES`` after the id."""

    def __init__(self, tiers=TIERS, pool_tokens: int = 1 << 20, step_tokens: int = 1 << 16, first: int = 0):
        self.tiers, self.pool_tokens, self.step_tokens = sorted(tiers), pool_tokens, step_tokens
        self.pieces: list[list[tuple[int, int, int]]] = [[] for _ in self.tiers]  # (length, document, start), ascending
        self.level_tokens = [0] * len(self.tiers)
        self.docs: dict[int, list] = {}
        self.seen = 0
        self.sequence, self.step = first, first
        self.open: dict[int, int] = {}

    def _route(self, doc: int, start: int, length: int) -> None:
        level = bisect.bisect_left(self.tiers, length)
        bisect.insort(self.pieces[level], (length, doc, start))
        self.level_tokens[level] += length

    def take(self, doc_id, ids: bytes) -> Iterator[tuple]:
        n, top = len(ids) // 4, self.tiers[-1]
        self.docs[self.seen] = [doc_id, ids, n, n]
        for start in range(0, n - n % top, top):
            yield from self._emit([(top, self.seen, start)], top)
        if n % top:
            self._route(self.seen, n - n % top, n % top)
        self.seen += 1
        if sum(self.level_tokens) >= self.pool_tokens:
            yield from self._pack()

    def _window(self, size: int, levels: range) -> list[tuple[int, int, int]]:
        """Pieces that fill ``size`` ids exactly, taken from the given tiers (long to short)."""
        got, room = [], size
        while room:
            for level in levels:
                own = self.pieces[level]
                at = bisect.bisect_right(own, (room, 1 << 62, 0)) - 1
                if at >= 0:
                    break
            else:  # nothing fits: cut the shortest piece that is longer
                level = next(x for x in reversed(levels) if self.pieces[x])
                length, doc, start = self.pieces[level].pop(0)
                self.level_tokens[level] -= length
                self._route(doc, start + room, length - room)
                got.append((room, doc, start))
                break
            got.append(own.pop(at))
            self.level_tokens[level] -= got[-1][0]
            room -= got[-1][0]
        return got

    def _pack(self) -> Iterator[tuple]:
        for level in range(len(self.tiers) - 1, -1, -1):
            size = self.tiers[level]
            while self.pieces[level] and sum(self.level_tokens[:level + 1]) >= size:
                yield from self._emit(self._window(size, range(level, -1, -1)), size)

    def close(self) -> Iterator[tuple]:
        yield from self._pack()
        every = range(len(self.tiers) - 1, -1, -1)
        while left := sum(self.level_tokens):
            size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
            yield from self._emit(self._window(size, every), size)

    def _group(self, size: int) -> int:
        group = max(self.open, key=self.open.get, default=None)
        if group is None or self.open[group] < size:
            group, self.step = self.step, self.step + 1
            self.open[group] = max(self.step_tokens, size)
        self.open[group] -= size
        if not self.open[group]:
            del self.open[group]
        return group

    def _emit(self, window: list[tuple[int, int, int]], size: int) -> Iterator[tuple]:
        group, offset = self._group(size), 0
        for length, doc, start in window:
            own = self.docs[doc]
            crc = zlib.crc32(memoryview(own[1])[4 * start:4 * (start + length)])
            yield own[0], start, length, crc, own[2], self.sequence, offset, size, group
            offset += length
            own[3] -= length
            if not own[3]:
                del self.docs[doc]
        self.sequence += 1


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                   tiers=TIERS, pool_tokens: int = 1 << 20, step_tokens: int = 1 << 16) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier (window size), step_group."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, schema = encoder(tokenizer_path), None
        packer = Packer(tiers, pool_tokens, step_tokens, TaskContext.get().partitionId() << 40)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            fields = [pa.field("id", batch.column("id").type)]
            fields += [pa.field(x.split()[0], pa.int64() if x.endswith("long") else pa.int32()) for x in PIECES.split(", ")]
            schema = pa.schema(fields)
            names = batch.column("id").to_pylist()
            for i, j, ids, at in own.batches(batch.column("text")):
                rows: list[tuple] = []
                for r in range(j - i):
                    rows.extend(packer.take(names[i + r], ids[at[r]:at[r + 1]].tobytes() + end))
                if rows:
                    yield out(rows)
        if schema is not None and (rows := list(packer.close())):
            yield out(rows)

    got = src.mapInArrow(run, f"id {kind}, {PIECES}")
    return got.withColumnRenamed("id", id_col)
