"""Token-id files of patched frame-of-reference blocks.

Documents are range-partitioned by id, a hash of the text and, for repeated rows, their place in the input, so that equal
ids fill as many partitions as they need.  They are sorted, encoded, and each partition becomes
one binary file or, beyond ``frames_per_file`` frames, several, written by Spark's own committed writer, so any file
system that Spark writes will do and a lost task leaves nothing behind.

File: frames one after the other, each followed by one byte 0x0A.  Frame, little-endian:

====================  ==========================================================
``PFR1``              magic, 4 bytes
u32 x 3               partition's number in id order, documents, blocks
u64 x 5               frame bytes, ids of the partition before the frame, ids in the frame,
                      bytes of the packed section, number of exceptions
i64 x documents       ids of the documents, then u8 x documents: 1 where the id is null
u64 x documents       token counts
u32, u8 x blocks      block minimum, packed width
u64, u64 x blocks     index: where the block starts in the packed section, and its first exception
packed section        ``BLOCK`` values of ``width`` bits a block, in 64-bit words
u8, u32 x exceptions  place in the block, bits above the width
====================  ==========================================================

A block's width is the ``percentile`` of the bit lengths of its values less the minimum;
values that need more bits keep their low bits in place and their high bits in the
exception list.  The block index lets ``read_ids`` decode any range alone.

Rows: a null text is empty; an empty text is its end id alone.  Null ids come first;
rows that share an id are ordered by a hash of the text.  An empty table gives files
without frames and no rows.  Only the named id and text columns are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import END_ID, materialize
from revlens.llm.encode import encoder

BLOCK = 256
_HEAD = struct.Struct("<4s3I5Q")
_MAGIC = b"PFR1"


def _pack(low: np.ndarray, w: int) -> np.ndarray:
    """Rows of 64 values to rows of ``w`` 64-bit words."""
    out = np.zeros((len(low), w), np.uint64)
    for j in range(64):
        word, shift = divmod(j * w, 64)
        out[:, word] |= low[:, j] << np.uint64(shift)
        if shift + w > 64:
            out[:, word + 1] |= low[:, j] >> np.uint64(64 - shift)
    return out


def _unpack(packed: np.ndarray, w: int) -> np.ndarray:
    out = np.empty((len(packed), 64), np.uint64)
    mask = np.uint64((1 << w) - 1)
    for j in range(64):
        word, shift = divmod(j * w, 64)
        v = packed[:, word] >> np.uint64(shift)
        if shift + w > 64:
            v = v | (packed[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = v & mask
    return out


def encode_frame(ids: np.ndarray, doc_ids: np.ndarray, null_ids: np.ndarray, counts: np.ndarray,
                 part: int, before: int, percentile: float = 0.9) -> bytes:
    n = len(ids)
    blocks = -(-n // BLOCK)
    v = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1] if n else 0, ids.dtype)]).astype(np.uint64).reshape(blocks, BLOCK)
    low = v.min(axis=1) if blocks else np.zeros(0, np.uint64)
    v = v - low[:, None]
    bits = np.frexp(v.astype(np.float64))[1].astype(np.uint8)
    at = min(BLOCK - 1, int(percentile * BLOCK))
    width = np.partition(bits, at, axis=1)[:, at] if blocks else np.zeros(0, np.uint8)
    over = bits > width[:, None]
    row, place = np.nonzero(over)
    high = (v[row, place] >> width[row].astype(np.uint64)).astype(np.uint32)
    size = width.astype(np.int64) * (BLOCK // 8)
    starts = np.cumsum(size) - size
    packed = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            lows = (v[own] & np.uint64((1 << int(w)) - 1)).reshape(-1, 64)
            data = _pack(lows, int(w)).reshape(len(own), -1).view(np.uint8)
            packed[starts[own][:, None] + np.arange(data.shape[1])] = data
    firsts = np.searchsorted(row, np.arange(blocks))
    body = b"".join([
        doc_ids.astype("<i8").tobytes(), null_ids.astype(np.uint8).tobytes(), counts.astype("<u8").tobytes(),
        low.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(), starts.astype("<u8").tobytes(), firsts.astype("<u8").tobytes(),
        packed.tobytes(), place.astype(np.uint8).tobytes(), high.astype("<u4").tobytes()])
    return _HEAD.pack(_MAGIC, part, len(doc_ids), blocks, _HEAD.size + len(body), before, n, len(packed), len(row)) + body


class Frame:
    """A frame at a place in a file's bytes."""

    def __init__(self, data, at: int = 0):
        magic, self.part, docs, blocks, self.bytes, self.before, self.n, packed, exceptions = _HEAD.unpack_from(data, at)
        if magic != _MAGIC:
            raise ValueError("not a token block frame")
        place = at + _HEAD.size

        def take(kind, count):
            nonlocal place
            got = np.frombuffer(data, kind, count, place)
            place += got.nbytes
            return got

        self.doc_ids, self.null_ids, self.counts = take("<i8", docs), take(np.uint8, docs), take("<u8", docs).astype(np.int64)
        self.low, self.width = take("<u4", blocks), take(np.uint8, blocks)
        self.starts, self.firsts = take("<u8", blocks).astype(np.int64), take("<u8", blocks).astype(np.int64)
        self.packed, self.places, self.high = take(np.uint8, packed), take(np.uint8, exceptions), take("<u4", exceptions)

    def read_ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo..hi of the frame; only the blocks that hold them are decoded."""
        hi = self.n if hi is None else hi
        if hi <= lo:
            return np.zeros(0, np.uint32)
        b0, b1 = lo // BLOCK, -(-hi // BLOCK)
        out = np.zeros((b1 - b0, BLOCK), np.uint64)
        width = self.width[b0:b1]
        for w in np.unique(width):
            if w:
                own = np.flatnonzero(width == w)
                data = self.packed[self.starts[b0:b1][own][:, None] + np.arange(int(w) * (BLOCK // 8))]
                out[own] = _unpack(np.ascontiguousarray(data).view(np.uint64).reshape(-1, int(w)), int(w)).reshape(len(own), BLOCK)
        ends = np.r_[self.firsts, len(self.places)]
        e0, e1 = ends[b0], ends[b1]
        row = np.repeat(np.arange(b1 - b0), np.diff(ends[b0:b1 + 1]))
        out[row, self.places[e0:e1]] |= self.high[e0:e1].astype(np.uint64) << width[row].astype(np.uint64)
        out += self.low[b0:b1, None].astype(np.uint64)
        return out.ravel()[lo - b0 * BLOCK:hi - b0 * BLOCK].astype(np.uint32)


def frames(data) -> Iterator[Frame]:
    at = 0
    while at < len(data):
        f = Frame(data, at)
        yield f
        at += f.bytes + 1


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, percentile: float = 0.9, frame_ids: int = 1 << 20, frames_per_file: int = 32) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending id order.  Ids are integers or null.

    A file is read back as one value of at most 2 GB; a frame has some 3 MB, and under 40 MB with empty texts only.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.select("id", "text", F.xxhash64("text").alias("spread"), F.monotonically_increasing_id().alias("place"))
    src = src.repartitionByRange("id", "spread", "place").sortWithinPartitions("id", "spread", "text").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        held: list[tuple] = []
        before = waiting = 0

        def frame():
            nonlocal before, waiting
            ids, names, nulls, counts = (np.concatenate(x) for x in zip(*held))
            data = encode_frame(ids, names, nulls, counts, part, before, percentile)
            before, waiting = before + len(ids), 0
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["frame"])

        for batch in batches:
            null = np.asarray(batch.column("id").is_null())
            names = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
            for i, j, ids, at in own.batches(batch.column("text")):
                out = np.insert(ids, at[1:], np.uint32(end_id))
                held.append((out, names[i:j], null[i:j], np.diff(at) + 1))
                waiting += len(out)
                if waiting >= frame_ids:
                    yield frame()
        if held:
            yield frame()

    src.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", frames_per_file).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for f in frames(content.as_buffer()):
                    ids = memoryview(f.read_ids().astype("<u4").tobytes())
                    ends = np.cumsum(f.counts)
                    crc = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip((ends - f.counts).tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids, mask=f.null_ids.astype(bool)), pa.array(np.full(len(crc), f.part, np.int32)),
                         pa.array(f.before + ends - f.counts), pa.array(f.counts), pa.array(crc, pa.int64())],
                        names=["doc_id", "part", "local", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    docs = materialize(spark, files.mapInArrow(run, "doc_id long, part int, local long, n_tokens long, ids_crc32 long"), "token-docs")
    totals = docs.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per partition written
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return (docs.join(F.broadcast(totals), "part")
            .select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))
