"""Exact deduplication over an extendible-hash index kept in shared files.

1. Every text gets a 64-bit key; counts per key are pre-aggregated per task, so
   a text that makes up a third of all rows is one row per task.
2. The directory is built by extendible hashing: a bucket is a prefix of the
   key; a bucket that holds more keys than ``bucket_keys`` is split on its next
   bit, and when its depth passes the directory's the directory doubles.  It is
   built from a histogram of key prefixes and has about ``keys / bucket_keys`` entries; past
   ``2 ** DIRECTORY_BITS`` buckets it grows no more, larger buckets take its place.
3. The index (bucket, key, rows, largest id) is written to the shared folder, dealt by bucket and
   sorted by key.  Rows find their bucket through the directory by the leading bits of their key.
4. Chains: texts, equal ones collapsed per task, and the index entries of keys with several rows go to the
   bucket's owner task, sorted by key.  It probes each key and compares the bytes of the texts that meet an
   entry; two texts that share a key get two chain slots and never merge.
5. Answers: rows (id, key, digest) and index entries go to the bucket's owner alike, which answers each row
   from the entry of its key.  Rows of a hot key are spread by id over several parts, each with a copy of the
   entry.  Rows of the keys with several chain slots find their slot by text.

An owner streams its sorted rows: it holds one entry (step 5) or the slots of one key (step 4) beside a batch.

Rows: a null text counts as empty; empty texts are equal to each other.  Null ids
lose every tie (a group of null ids only keeps id null).  Repeated rows (same id and
text) are all returned and all counted, and all carry the id that stays.  An empty
table gives no rows.  Only the named id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import materialize

DIRECTORY_BITS = 16  # past this many buckets they grow instead, so the directory has a fixed largest size
HELD_BYTES = 32 << 20  # texts that a task holds to collapse equal ones before the shuffle


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(histogram: dict[int, int], fine: int, bucket_keys: int) -> tuple[int, list[int]]:
    """Global depth and, for each directory slot, the slot's bucket (its first slot's number).

    ``histogram``: keys per ``fine``-bit prefix.  Buckets split until they hold at most
    ``bucket_keys`` keys or reach ``fine`` bits.
    """
    depth, buckets = 0, [(0, 0)]  # (local depth, prefix)
    size = {(0, 0): sum(histogram.values())}
    for bits in range(1, fine + 1):
        for p, n in histogram.items():
            q = (bits, p >> (fine - bits))
            size[q] = size.get(q, 0) + n
    todo, done = buckets, []
    while todo:
        local, p = todo.pop()
        if size.get((local, p), 0) > bucket_keys and local < fine:
            depth = max(depth, local + 1)  # the directory doubles when a split passes its depth
            todo += [(local + 1, 2 * p), (local + 1, 2 * p + 1)]
        else:
            done.append((local, p))
    slots = [0] * (1 << depth)
    for local, p in done:
        first = p << (depth - local)
        for s in range(first, first + (1 << (depth - local))):
            slots[s] = first
    return depth, slots


def _larger(a, b):
    """The larger id; a null loses."""
    return b if a is None else a if b is None else max(a, b)


def _collapsed(rows: DataFrame, kind: str) -> DataFrame:
    """Rows (bucket, key, id, text) with equal texts of a task summed, as long as they fit in ``HELD_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def flush():
            keys = list(held)
            cols = zip(*held.values())
            bucket, top, n = (list(c) for c in cols)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array([k for k, _ in keys], pa.int64()), pa.array(n, pa.int64()),
                 pa.array(top, id_type), pa.array([t for _, t in keys], pa.string())], names=["bucket", "key", "n", "top", "text"])

        for batch in batches:
            id_type = batch.column("id").type
            bucket, key, ids = (batch.column(c).to_pylist() for c in ("bucket", "key", "id"))
            for b, k, i, t in zip(bucket, key, ids, batch.column("text")):
                t = t.as_py()
                old = held.get((k, t))
                if old:
                    held[k, t] = b, _larger(old[1], i), old[2] + 1
                    continue
                held[k, t] = b, i, 1
                size += len(t)
                if size >= HELD_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return rows.mapInArrow(run, f"bucket long, key long, n long, top {kind}, text string")


def _chains(dealt: DataFrame, kind: str) -> DataFrame:
    """Owner tasks, step 4: the slots of every key with several texts.  An index entry (null text) precedes the texts of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, slots = None, {}

        def close():
            own = [(open_key, t, n, top) for t, (n, top) in slots.items()] if len(slots) > 1 else []
            cols = list(zip(*own)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                                               pa.array(cols[3], id_type)], names=["key", "text", "size", "keep"])

        for batch in batches:
            id_type = batch.column("top").type
            key, text = batch.column("key").to_numpy(), batch.column("text")
            entry = text.is_null().to_numpy(zero_copy_only=False)
            # the key of the last entry before each row; keys of the rows before a batch's first entry belong to the open one
            last = np.maximum.accumulate(np.where(entry, np.arange(len(key)), -1))
            met = np.where(last >= 0, key[last] == key, key == open_key if open_key is not None else False)
            for j in np.flatnonzero(met):
                if entry[j]:
                    if len(slots) > 1:
                        yield close()
                    open_key, slots = int(key[j]), {}
                    continue
                t, top = text[j].as_py(), batch.column("top")[j].as_py()
                n = batch.column("n")[j].as_py()
                old = slots.get(t)
                slots[t] = (old[0] + n, _larger(old[1], top)) if old else (n, top)
        if len(slots) > 1:
            yield close()

    return dealt.mapInArrow(run, f"key long, text string, size long, keep {kind}")


def _answers(dealt: DataFrame, kind: str) -> DataFrame:
    """Owner tasks, step 5: every row with the count and largest id of its key's entry (null digest), which precedes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            table = table.combine_chunks()
            entry = pc.is_null(table.column("text_sha256")).to_numpy()
            last = np.maximum.accumulate(np.where(entry, np.arange(len(entry)), 0))
            own = np.flatnonzero(~entry)
            key = table.column("key").to_numpy()
            if not (entry[0] and (key[last[own]] == key[own]).all()):
                raise RuntimeError("a key is not in the index: the table changed while it was read")
            for got in pa.table({"id": table.column("id").take(own), "key": key[own], "keep": table.column("top").take(last[own]),
                                 "size": table.column("n").take(last[own]), "text_sha256": table.column("text_sha256").take(own)}).to_batches():
                yield got
            kept = table.slice(last[-1], 1)

    return dealt.mapInArrow(run, f"id {kind}, key long, keep {kind}, size long, text_sha256 string")


def exact_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bucket_keys: int = 1 << 12, key_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: id, keep_id (largest id of its group), group_size, kept, text_sha256.

    ``key_bits`` below 64 shortens the keys (tests use it to force chains).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(text)
    if key_bits < 64:
        key = F.shiftleft(key, 64 - key_bits)
    src = docs.select(F.col(id_col).alias("id"), text.alias("text"), key.alias("key"))
    keys = materialize(spark, src.groupBy("key").agg(F.count("*").alias("rows"), F.max("id").alias("top")), "keys")

    total = keys.count()
    bucket_keys = max(bucket_keys, total >> DIRECTORY_BITS)
    fine = (total // bucket_keys).bit_length() + 3
    parts = keys.groupBy(_prefix(F.col("key"), fine).alias("p")).count().collect()  # at most 2**fine rows, about 8 a bucket
    depth, slots = build_directory({r["p"]: r["count"] for r in parts}, fine, bucket_keys)
    # as long as the directory: at most 2**(DIRECTORY_BITS + 4) slots
    directory = F.broadcast(spark.createDataFrame(list(enumerate(slots)), "slot long, bucket long"))

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("slot", _prefix(F.col("key"), depth)).join(directory, "slot").drop("slot")

    index = materialize(spark, placed(keys).repartition("bucket").sortWithinPartitions("bucket", "key"), "index")
    rows = index.agg(F.sum("rows")).first()[0] or 0

    entries = index.where("rows > 1").select("bucket", "key", F.col("rows").alias("n"), "top", F.lit(None).cast("string").alias("text"))
    dealt = (_collapsed(placed(src).select("bucket", "key", "id", "text"), kind).unionByName(entries)
             .repartition("bucket").sortWithinPartitions("bucket", "key", F.col("text").isNotNull()))
    chain = materialize(spark, _chains(dealt, kind), "chains")

    share = max(1, rows // 1000)  # at most a thousand keys have more rows
    hot = index.where(F.col("rows") > share).select("key", F.ceil(F.col("rows") / share).cast("int").alias("parts"))
    narrow = src.select("id", "key", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    spread = F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)).cast("int")
    asked = placed(narrow.join(F.broadcast(hot), "key", "left")).select(
        "bucket", spread.alias("part"), "key", "id", "text_sha256", F.lit(None).cast("long").alias("n"), F.lit(None).cast(kind).alias("top"))
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("rows") > share, F.ceil(F.col("rows") / share).cast("int") - 1).otherwise(0)))
    entries = index.select("bucket", copies.alias("part"), "key", F.lit(None).cast(kind).alias("id"),
                           F.lit(None).cast("string").alias("text_sha256"), F.col("rows").alias("n"), "top")
    dealt = (asked.unionByName(entries).repartition("bucket", "part")
             .sortWithinPartitions("bucket", "part", "key", F.col("text_sha256").isNotNull()))
    got = _answers(dealt, kind)
    if not chain.isEmpty():  # texts share a key: their rows are answered by slot
        clash = chain.select("key").distinct()
        own = src.join(clash, "key", "left_semi").join(chain, ["key", "text"])
        got = (got.join(clash, "key", "left_anti").drop("key")
               .unionByName(own.select("id", "keep", "size", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))))
    return got.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
                      F.col("id").eqNullSafe(F.col("keep")).alias("kept"), "text_sha256")
