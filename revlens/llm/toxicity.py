"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word pairs and pairs with one word between,
hashed to ``2 ** bits`` coordinates.  Per-coordinate rates and L1 make the
weights sparse; the non-zero ones (a sorted index array and a value array) are broadcast to score.

Training: a bounded sample of the labelled rows (``max_train_rows``, drawn by a hash of the
id) is dealt to groups of about ``SHARD_ROWS``, so there are at most ``max_train_rows / SHARD_ROWS``.  In every round each shard runs FTRL over its rows from the common
state and returns what it changed; a coordinate's new state is the old one plus the mean change over the shards
that touched it.  A coordinate is included if ``min_rows`` rows of the whole sample have it, however they are dealt;
which of these have a weight is left to L1.  Spark sums counts and changes by coordinate range, so the driver gets the size of the model.

Rows: a null or empty text has the bias as its only feature.  Labels that are null, or of a null id, are not learned from;
if an id has several labels, the largest counts.  Where ids repeat, equal rows are learned from once, and the bound holds for
rows: they are drawn by id and text.  Without labelled rows of both
classes every score is the share of label 1 (0.5 without any row).  Null ids, rows that share an id and repeated
rows are scored each by itself.  An empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import materialize
from revlens.llm.textops import ALNUM, mix, pack_planes, text_chunks, unpack_planes, words

SHARD_ROWS = 5000
RANGES = 32
_CHANGE = pa.schema([*((c, pa.int32()) for c in ("shard", "range", "size")), *((c, pa.binary()) for c in ("new", "once", "z", "n"))])
_U = np.uint64
_PAIR, _SKIP = _U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25)


def _features(h: np.ndarray, wo: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all words, pairs and skip pairs of a batch, and the text each belongs to (with repeats)."""
    doc = np.repeat(np.arange(len(wo) - 1), np.diff(wo))
    parts, owners = [h], [doc]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            inside = doc[:-gap] == doc[gap:]
            parts.append(mix(h[:-gap] * salt + h[gap:])[inside])
            owners.append(doc[:-gap][inside])
    return (np.concatenate(parts) >> _U(64 - bits)).astype(np.int64), np.concatenate(owners)


def sample_labels(labels: DataFrame, id_col: str, label_col: str, train: Column, max_rows: int) -> DataFrame:
    """Learnable labels ``(id, y)``, about ``max_rows`` at most, drawn by a hash of the id."""
    rows = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train)
            .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return rows


def _labelled(spark: SparkSession, docs: DataFrame, sample: DataFrame, max_rows: int) -> tuple[DataFrame, Column, int]:
    """Rows (id, text, y) of the sampled ids, the hash that deals them, and about how many they are (``max_rows`` at most)."""
    rows = docs.join(F.broadcast(sample), "id")  # the sample is bounded by max_rows
    n, ids = rows.select("id").agg(F.count("*"), F.count_distinct("id")).first()
    if n == ids:
        return rows, F.xxhash64("id", F.lit(1)), n
    # ids repeat, so a bound on ids is none on rows: repeated rows collapse per task, then rows are drawn by id and text
    rows = materialize(spark, rows.select("id", "y", "text").distinct(), "tox-rows")
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("id", "text", F.lit(2)), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return rows, F.xxhash64("id", "text", F.lit(1)), min(n, max_rows)


def _training_rows(rows: DataFrame, pick: Column, bits: int, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, ALNUM)
                at, doc = _features(h, wo, bits)
                both = np.unique((doc << bits) | at)
                cut = np.searchsorted(both >> bits, np.arange(j - i + 1))
                at = (both & ((1 << bits) - 1)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in ("shard", "pick", "y")),
                     pa.array([pack_planes(np.diff(at[a:b], prepend=np.uint32(0))) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["shard", "pick", "y", "at"])

    rows = rows.select(F.pmod(pick, F.lit(shards)).cast("int").alias("shard"), pick.alias("pick"), "y", "text")
    return rows.mapInArrow(run, "shard int, pick long, y int, at binary")


def _shard_rows(gaps: bytes, size: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of the rows of a shard, and where each row ends."""
    ends = np.cumsum(np.frombuffer(size, np.int32))
    total = np.r_[0, np.cumsum(unpack_planes(gaps, np.uint32), dtype=np.int64)]
    begin = np.r_[0, ends[:-1]]
    return (total[1:] - np.repeat(total[begin], ends - begin)).astype(np.int32), ends


class Ftrl:
    """State of an FTRL-proximal learner: gradient sums ``z`` and squared gradient sums ``n`` per coordinate; the last is the bias."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size + 1, np.float32), np.zeros(size + 1, np.float32)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0, w)

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
        g = np.float32(p - y)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] += g * g


def _range_cuts(mask: np.ndarray) -> np.ndarray:
    """Where each of ``RANGES`` equal coordinate ranges begins among the coordinates of a mask; the bias ends the last one."""
    cuts = np.searchsorted(np.flatnonzero(mask), np.arange(RANGES + 1) * len(mask) // RANGES)
    cuts[-1] += 1
    return cuts


def frequent(shards: DataFrame, bits: int, min_rows: int) -> np.ndarray:
    """Mask of the coordinates that ``min_rows`` rows of the whole sample have: counts by range, summed by Spark."""
    width = (1 << bits) // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                seen = np.bincount(_shard_rows(r["at"], r["size"])[0], minlength=1 << bits).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array([pack_planes(x) for x in np.split(seen, RANGES)])],
                                                 names=["range", "seen"])

    def add(table: pa.Table) -> pa.Table:
        seen = np.zeros(width, np.int64)
        for own in table.column("seen").to_pylist():
            seen += unpack_planes(own, np.uint32)
        return pa.table({"range": table.column("range")[:1], "mask": [np.packbits(seen >= min_rows).tobytes()]})

    got = shards.select("at", "size").mapInArrow(count, "range int, seen binary").groupBy("range").applyInArrow(add, "range int, mask binary")
    mask = np.zeros((RANGES, width), bool)
    for r in got.collect():  # a bit a coordinate
        mask[r["range"]] = np.unpackbits(np.frombuffer(r["mask"], np.uint8), count=width)
    return mask.ravel()


def fit(spark: SparkSession, rows: DataFrame, bits: int, rounds: int, min_rows: int, alpha: float, beta: float, l1: float, l2: float):
    """Non-zero weights: (ascending coordinates, values, bias)."""

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        """A shard as one row: the coordinates of its texts, in a fixed order."""
        pdf = pdf.sort_values(["pick", "y"], kind="stable")
        own = [unpack_planes(b, np.uint32) for b in pdf["at"]]
        return pd.DataFrame({"shard": pdf["shard"].to_numpy()[:1], "at": [pack_planes(np.concatenate(own))],
                             "size": [np.array([len(x) for x in own], np.int32).tobytes()],
                             "y": [pdf["y"].to_numpy(np.int32).tobytes()]})

    shards = materialize(spark, rows.groupBy("shard").applyInPandas(gather, "shard int, at binary, size binary, y binary"), "tox-shards")
    mask = frequent(shards, bits, min_rows)
    packed, cuts = np.packbits(mask), _range_cuts(mask)
    model = Ftrl(int(mask.sum()), alpha, beta, l1, l2)  # of the included coordinates alone

    def add(table: pa.Table) -> pa.Table:
        """The mean change of a range over the shards that touched each coordinate; shards in a fixed order."""
        size = table.column("size")[0].as_py()
        dz, dn, hits = np.zeros(size, np.float32), np.zeros(size, np.float32), np.zeros(size, np.int32)
        for r in sorted(table.to_pylist(), key=lambda r: r["shard"]):
            new, once = (np.unpackbits(np.frombuffer(r[c], np.uint8), count=size).view(bool) for c in ("new", "once"))
            z = unpack_planes(r["z"], np.float32)
            n = z * z
            n[~once[new]] = unpack_planes(r["n"], np.float32)
            dz[new] += z
            dn[new] += n
            hits += new
        hits = np.maximum(hits, 1)
        return pa.table({"range": table.column("range")[:1], "z": [(dz / hits).astype(np.float32).tobytes()],
                         "n": [(dn / hits).astype(np.float32).tobytes()]})

    for _ in range(rounds):
        state = spark.sparkContext.broadcast((packed, model.z, model.n))

        def train(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    packed, z0, n0 = state.value
                    use = np.unpackbits(packed, count=1 << bits).view(bool)
                    place = np.cumsum(use, dtype=np.int32) - 1
                    own = Ftrl(len(z0) - 1, alpha, beta, l1, l2)
                    own.z[:], own.n[:] = z0, n0
                    every, ends = _shard_rows(r["at"], r["size"])
                    # a single row of the shard has it, at weight 0: n changes by the square of z's change and is not sent
                    once = np.append(np.bincount(every, minlength=1 << bits)[use] == 1, False) & (own.weights(np.arange(len(z0))) == 0)
                    for at, y in zip(np.split(every, ends[:-1]), np.frombuffer(r["y"], np.int32).tolist()):
                        own.learn(np.append(place[at[use[at]]], len(z0) - 1), y)
                    for i in range(RANGES):
                        part = slice(cuts[i], cuts[i + 1])
                        new = own.n[part] != n0[part]
                        if new.any():
                            yield pa.RecordBatch.from_pylist([{
                                "shard": r["shard"], "range": i, "size": len(new),
                                "new": np.packbits(new).tobytes(), "once": np.packbits(once[part]).tobytes(),
                                "z": pack_planes((own.z[part] - z0[part])[new]),
                                "n": pack_planes((own.n[part] - n0[part])[new & ~once[part]])}], schema=_CHANGE)

        changes = shards.mapInArrow(train, "shard int, range int, size int, new binary, once binary, z binary, n binary")
        # a row a range, all together the size of the model, whatever the number of shards
        for r in changes.groupBy("range").applyInArrow(add, "range int, z binary, n binary").collect():
            part = slice(cuts[r["range"]], cuts[r["range"] + 1])
            model.z[part] += np.frombuffer(r["z"], np.float32)
            model.n[part] += np.frombuffer(r["n"], np.float32)
        state.destroy()
    w = model.weights(np.arange(len(model.z)))
    at = np.flatnonzero(w[:-1])
    return np.flatnonzero(mask)[at], w[at].astype(np.float64), float(w[-1])


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic",
                   id_col: str = "doc_id", text_col: str = "text", bits: int = 22, rounds: int = 6, min_rows: int = 2,
                   alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 1.0, max_train_rows: int = 40_000) -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1).  ``train`` is a condition on the id column of ``labels``."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = materialize(spark, sample_labels(labels, id_col, label_col, train, max_train_rows), "tox-labels")
    seen = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if set(seen) >= {0, 1}:
        rows, pick, n = _labelled(spark, src, sample, max_train_rows)
        rows = _training_rows(rows, pick, bits, max(1, -(-n // SHARD_ROWS)))
        model = fit(spark, rows, bits, rounds, min_rows, alpha, beta, l1, l2)
    else:
        share = (seen.get(1, 0) + 0.5) / (sum(seen.values()) + 1)
        model = np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share)))
    shared = spark.sparkContext.broadcast(model)  # non-zero weights, at most 2**bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value, bias = shared.value
        table = np.zeros(1 << bits, bool)
        table[known] = True
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, ALNUM)
                at, doc = _features(h, wo, bits)
                hit = table[at]
                both = np.unique((doc[hit] << bits) | at[hit])
                w = value[np.searchsorted(known, both & ((1 << bits) - 1))] if len(both) else np.zeros(0)
                logit = bias + np.bincount(both >> bits, w, j - i)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array(1 / (1 + np.exp(-np.clip(logit, -500, 500))))],
                                                 names=["id", "score"])

    return src.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
