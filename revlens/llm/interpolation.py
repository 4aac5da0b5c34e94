"""Language-model scoring by deleted interpolation.

``P(w | v) = l2(b) c(v, w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)``: maximum-likelihood
bigram, unigram and uniform estimates, mixed with weights that depend on the bucket
``b`` of the context's frequency ``c(v)`` (powers of two).  The weights are learned by
expectation-maximisation on a deleted part of the training documents, with
the counts of the rest; the final estimates use the counts of all training documents.

Data flow, all of it in tables of blocks (numpy arrays in binary columns):

1. Each scan task cuts its documents into chunks and writes, per chunk, its token
   sequence and its distinct unigram and bigram hashes with their training counts.  A word that
   makes up a third of all tokens is thus one entry per chunk.
2. Hash ranges are summed by owner tasks (one per ``range_bytes`` of text), which answer each
   chunk with the corpus counts of its entries.
3. Chunks meet their answers (co-group by chunk) and are scored.

Counts are exact, over all training documents, and nothing of the corpus goes through
the driver but N, V and the mixture weights.

Rows: a null or empty text is its end token alone.  A null id is the empty text in the splits;
rows that share an id, repeated rows too, are scored each by itself and counted each.  An empty table
gives no rows; without training tokens all estimates are uniform.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import materialize
from revlens.llm.textops import SPACED, mix, pack_planes, text_chunks, unpack_planes, words

_U = np.uint64
END = _U(0x5BD1E995C0FFEE11)  # hash of the end token; it is also the context of a first word
_LEFT, _RIGHT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
BUCKETS = 24

_CHUNK = ("chunk long, role int, doc_ids array<string>, held array<boolean>, counts binary, vocabulary binary, tokens binary, "
          "gram int, range long, keys binary, train binary, deleted binary, types long, total long, total_deleted long")


def _entries(h: np.ndarray, ends: np.ndarray):
    """Distinct tokens and bigrams of a chunk (documents end at ``ends``, end tokens included).

    Returns (unigram hashes, token places in them, bigram hashes ascending, bigram places in them).
    """
    vocabulary, at = np.unique(h, return_inverse=True)
    at = at.astype(np.uint32)
    before = np.r_[np.searchsorted(vocabulary, END).astype(np.uint32), at[:-1]] if len(at) else at
    pairs, pair_at = np.unique((before.astype(_U) << _U(32)) | at.astype(_U), return_inverse=True)
    hashed = mix(vocabulary[(pairs >> _U(32)).astype(np.int64)] * _LEFT + vocabulary[(pairs & _U(0xFFFFFFFF)).astype(np.int64)] * _RIGHT)
    order = np.argsort(hashed)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return vocabulary, at, before, hashed[order], rank[pair_at]


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Owner of each key: equal stretches of the 64-bit hash space."""
    return ((keys >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def _delta(keys: np.ndarray) -> bytes:
    return pack_planes(np.diff(keys, prepend=_U(0)))


def _undelta(b: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(b, _U), dtype=_U)


def _rows(n: int, **given) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
             "array<boolean>": pa.list_(pa.bool_())}
    cols = [c.split(" ", 1) for c in _CHUNK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(given.get(name, [None] * n), types[t]) for name, t in cols], names=[c[0] for c in cols])


def _blocks(docs: DataFrame, ranges: int, chunk_bytes: int) -> DataFrame:
    """Step 1: token rows and entry rows of every chunk, for all documents (role 0) and the deleted ones (role 1)."""

    def emit(chunk, role, texts, ids, held, train, deleted):
        hashes, counts = texts
        ends = np.cumsum(counts)
        vocabulary, at, before, bigrams, pair_at = _entries(hashes, ends)
        often = np.argsort(-np.bincount(at, minlength=len(vocabulary)), kind="stable")  # common tokens get small numbers
        rank = np.empty(len(often), np.uint32)
        rank[often] = np.arange(len(often), dtype=np.uint32)
        yield _rows(1, chunk=[chunk], role=[role], gram=[0], range=[chunk], doc_ids=[ids], held=[held], counts=[counts.astype("<i8").tobytes()],
                    vocabulary=[vocabulary[often].tobytes()], tokens=[pack_planes(rank[at])])
        of = np.repeat(np.arange(len(counts)), counts)
        for gram, keys, place in ((1, vocabulary, at), (2, bigrams, pair_at)):
            sums = [np.bincount(place[flag[of]], minlength=len(keys)).astype(np.uint32) if role == 0 else np.zeros(len(keys), np.uint32)
                    for flag in (train, deleted)]
            cut = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
            own = [r for r in range(ranges) if cut[r] < cut[r + 1]]
            yield _rows(len(own), chunk=[chunk] * len(own), role=[role] * len(own), gram=[gram] * len(own), range=own,
                        keys=[_delta(keys[cut[r]:cut[r + 1]]) for r in own],
                        train=[pack_planes(sums[0][cut[r]:cut[r + 1]]) for r in own],
                        deleted=[pack_planes(sums[1][cut[r]:cut[r + 1]]) for r in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq = TaskContext.get().partitionId() << 24, 0
        held_back: list[tuple] = []
        size = 0

        def flush():
            nonlocal seq, size
            hashes, counts, ids, held, train, deleted = zip(*held_back)
            hashes, counts, ids = np.concatenate(hashes), np.concatenate(counts), [x for own in ids for x in own]
            held, train, deleted = (np.concatenate(x) for x in (held, train, deleted))
            yield from emit(base + 2 * seq, 0, (hashes, counts), ids, held.tolist(), train, deleted)
            if deleted.any():
                own = hashes[np.repeat(deleted, counts)]
                names = [x for x, d in zip(ids, deleted) if d]
                yield from emit(base + 2 * seq + 1, 1, (own, counts[deleted]), names, held[deleted].tolist(), train[deleted], deleted[deleted])
            seq, size = seq + 1, 0
            held_back.clear()

        for batch in batches:
            flags = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False), bool) for c in ("held", "train", "deleted")]
            for i, j, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, SPACED)
                held_back.append((np.insert(h, wo[1:], END), np.diff(wo) + 1, batch.column("id").slice(i, j - i).to_pylist(), *(f[i:j] for f in flags)))
                size += len(data)
                if size >= chunk_bytes:
                    yield from flush()
        if held_back:
            yield from flush()

    return docs.mapInArrow(run, _CHUNK)


def _answers(blocks: DataFrame) -> DataFrame:
    """Step 2: owners of hash ranges sum the counts and answer every chunk; one row with types and totals a range of unigrams.

    The token rows pass through the same shuffle, each as a group of its own, so entries are never stored.
    """

    def run(table: pa.Table) -> pa.Table:
        gram = table.column("gram")[0].as_py()
        if not gram:
            return table
        rows = table.select(["chunk", "role", "range", "keys", "train", "deleted"]).to_pylist()
        keys = [_undelta(r["keys"]) for r in rows]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        known = every[first]
        sums = [np.add.reduceat(np.concatenate([unpack_planes(r[c], np.uint32) for r in rows]).astype(np.int64)[order], first)
                for c in ("train", "deleted")]
        at = [np.searchsorted(known, k) for k in keys]
        given = {c: [r[c] for r in rows] for c in ("chunk", "role", "range")}
        out = [_rows(len(rows), **given, gram=[gram] * len(rows), train=[pack_planes(sums[0][x]) for x in at],
                     # only the deleted part is scored without itself
                     deleted=[pack_planes(sums[1][x]) if r["role"] else None for r, x in zip(rows, at)])]
        if gram == 1:
            out.append(_rows(1, gram=[1], range=[rows[0]["range"]], types=[int((sums[0] > 0).sum())], total=[int(sums[0].sum())],
                             total_deleted=[int(sums[1].sum())]))
        return pa.Table.from_batches(out)

    return blocks.groupBy("gram", "range").applyInArrow(run, _CHUNK)


def _chunk_counts(left: pa.Table, right: pa.Table, parts: tuple[str, ...]):
    """A chunk's token row with the corpus counts of its tokens, contexts and bigrams: (row, token counts per document, counts)."""
    row = left.to_pylist()[0]
    counts = np.frombuffer(row["counts"], "<i8").astype(np.int64)
    vocabulary = np.frombuffer(row["vocabulary"], _U)
    hashes = vocabulary[unpack_planes(row["tokens"], np.uint32)]
    _, at, before, _, pair_at = _entries(hashes, np.cumsum(counts))
    answers = sorted(right.to_pylist(), key=lambda r: (r["gram"], r["range"]))
    got = {}
    for c in parts:
        uni, pair = (np.concatenate([unpack_planes(r[c], np.int64) for r in answers if r["gram"] == gram]) for gram in (1, 2))
        got[c] = uni[at], uni[before], pair[pair_at]
    return row, counts, got


def _estimates(word, context, pair, n: int, types: int):
    """Bucket of the context and the three estimates of each token."""
    p0 = 1.0 / (types + 1)
    p1 = word / n if n else np.full(len(word), p0)
    p2 = np.divide(pair, context, out=np.zeros(len(word)), where=context > 0)
    bucket = np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)
    return bucket, p2, p1, p0


def learn_weights(spark: SparkSession, samples: DataFrame, p0: float, rounds: int) -> np.ndarray:
    """Expectation-maximisation over blocks of (bucket, p2, p1) held-out tokens; rows of ``BUCKETS`` x 3 weights."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5  # an unseen context has no bigram estimate

    for _ in range(rounds):
        def step(batches, weights=weights):
            total = np.zeros((BUCKETS, 3))
            for batch in batches:
                for b, p2, p1 in zip(*(batch.column(c) for c in ("bucket", "p2", "p1"))):
                    k = np.frombuffer(b.as_buffer(), np.uint8)
                    part = weights[k] * np.stack([np.frombuffer(p2.as_buffer(), np.float32), np.frombuffer(p1.as_buffer(), np.float32),
                                                  np.full(len(k), p0)], axis=1)
                    part /= part.sum(axis=1, keepdims=True)
                    for i in range(3):
                        total[:, i] += np.bincount(k, part[:, i], BUCKETS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), *(pa.array(total[:, i]) for i in range(3))],
                                             names=["bucket", "s2", "s1", "s0"])

        sums = samples.mapInArrow(step, "bucket int, s2 double, s1 double, s0 double").groupBy("bucket").agg(
            F.sum("s2").alias("s2"), F.sum("s1").alias("s1"), F.sum("s0").alias("s0")).toPandas()
        for r in sums.itertuples():
            own = np.array([r.s2, r.s1, r.s0])
            if own.sum() > 0:
                weights[r.bucket] = own / own.sum()
    weights = np.maximum(weights, [0, 1e-9, 1e-9])
    return weights / weights.sum(axis=1, keepdims=True)


def score_documents(spark: SparkSession, docs: DataFrame, train: Column, deleted: Column, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = 12, range_bytes: int = 8 << 20, chunk_bytes: int = 6 << 20) -> DataFrame:
    """One row per row of ``docs``: id, held_out (not ``train``), n_tokens, n_known, train_tokens, base_score, score.

    ``train`` marks the documents learned from, ``deleted`` those of them on which the
    weights are learned.  Scores are log10 probabilities of whole texts.
    """
    kind = docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("string").alias("id"), text.alias("text"), (~train).alias("held"),
                      train.alias("train"), (train & deleted).alias("deleted"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    answers = materialize(spark, _answers(_blocks(src, max(1, math.ceil(total / range_bytes)), chunk_bytes)), "lm-answers")
    tokens = answers.where("gram = 0")
    stats = answers.agg(F.sum("types"), F.sum("total"), F.sum("total_deleted")).first()
    types, n, n_deleted = (int(x or 0) for x in stats)

    def meet(role: int):
        left = tokens.where(F.col("role") == role).select(
            "chunk", "doc_ids", "held", "counts", "vocabulary", "tokens")
        right = answers.where((F.col("gram") > 0) & (F.col("role") == role)).select("chunk", "gram", "range", "train", "deleted")
        return left.groupBy("chunk").cogroup(right.groupBy("chunk"))

    def sample(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, got = _chunk_counts(left, right, ("train", "deleted"))
        word, context, pair = (a - b for a, b in zip(got["train"], got["deleted"]))
        bucket, p2, p1, _ = _estimates(word, context, pair, n - n_deleted, types)
        return pa.table({"bucket": [bucket.astype(np.uint8).tobytes()], "p2": [p2.astype(np.float32).tobytes()],
                         "p1": [p1.astype(np.float32).tobytes()]})

    samples = materialize(spark, meet(1).applyInArrow(sample, "bucket binary, p2 binary, p1 binary"), "lm-samples")
    weights = learn_weights(spark, samples, 1.0 / (types + 1), rounds)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row, counts, got = _chunk_counts(left, right, ("train",))
        word, context, pair = got["train"]
        bucket, p2, p1, p0 = _estimates(word, context, pair, n, types)
        own = weights[bucket]
        p = np.log10(own[:, 0] * p2 + own[:, 1] * p1 + own[:, 2] * p0)
        base = np.log10((word + 1) / (n + types + 1))
        first = np.cumsum(counts) - counts
        return pa.table({"id": pa.array(row["doc_ids"], pa.string()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": counts,
                         "n_known": np.add.reduceat((word > 0).astype(np.int64), first),
                         "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(p, first)})

    got = meet(0).applyInArrow(score, "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return got.select(F.col("id").cast(kind).alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
