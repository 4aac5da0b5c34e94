"""Quality scores by positive-unlabelled learning (non-negative unbiased risk).

Trusted positives are documents labelled 1; the unlabelled set is drawn from all documents, whatever their
label, which it never sees.  With class prior ``p`` the risk of the negative class is estimated as
``R_u(-) - p R_p(-)`` and kept from falling below 0: when a step's estimate is negative, the step
ascends it instead.  The prior is the share of label 1 among the labels that may be learned from,
or ``prior`` if given.

Features are counts and ratios of a text (case, digits, marks, blanks, word lengths, repeated
words and lines), cut into quantile bins; the model is a logistic regression over the bins.

Everything is learned from all documents.  One pass writes the features of every document (80 bytes each); the bin edges are
quantiles that Spark aggregates over all of them; the binned rows are written once, in blocks.  Each step of the fit is a
Spark job that sums the losses and gradients of the positive and the unlabelled part per task and then by coordinate, and only these
sums (some hundred numbers) reach the driver, which moves the weights (Adam).

Rows: a null text is empty; an empty text has features like any other.  Labels that are null, or of a null id, are not
learned from; if an id has several labels, the largest counts, and all rows of a positive id are positives.  Without positives every score is
the prior (0.5 without labels).  Null ids, rows that share an id and repeated rows are scored each by itself.  An empty
table gives no rows.  Only the named columns are read, and ``keep_quality`` returns all columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import materialize, text_key
from revlens.llm.textops import SPACED, text_chunks, words

FEATURES = 20
_BLOCK = 8192  # binned rows in a record


def text_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """``texts x FEATURES`` matrix of a batch of texts."""
    n_docs = len(offs) - 1

    def total(mask):
        sums = np.r_[0, np.cumsum(mask, dtype=np.int64)]
        return (sums[offs[1:]] - sums[offs[:-1]]).astype(np.float64)

    size = np.diff(offs).astype(np.float64)
    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    newline, blank = data == 10, (data == 32) | ((data >= 9) & (data <= 13))
    mark = ~(letter | digit | blank)
    stop, comma = data == ord("."), data == ord(",")
    other = mark & ~stop & ~comma
    h, wo = words(data, offs, SPACED)
    n = np.diff(wo).astype(np.float64)
    doc = np.repeat(np.arange(n_docs), np.diff(wo))
    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    distinct = np.bincount(_distinct(doc, h), minlength=n_docs).astype(np.float64)
    repeats = np.bincount(doc, same, n_docs)
    pairs = _distinct(doc[1:], h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1]) if len(h) > 1 else np.zeros(0, np.int64)
    bigrams = np.bincount(pairs, minlength=n_docs).astype(np.float64)
    adjacent = np.zeros(len(data), bool)
    if len(data) > 1:
        adjacent[1:] = other[1:] & (data[1:] == data[:-1])
    letters, nw, nc = np.maximum(total(letter), 1), np.maximum(n, 1), np.maximum(size, 1)
    counted = {c: total(data == ord(c)) / nw for c in "!|$%#"}
    return np.stack([
        np.log1p(size), np.log1p(n), total(letter) / nc, total(upper) / letters, total(digit) / nc, total(mark) / nc, total(other) / nw,
        total(adjacent) / nw, total(stop) / nw, total(comma) / nw, total(newline) / nw, total(data >= 128) / nc, size / nw,
        distinct / nw, repeats / nw, bigrams / nw, *(counted[c] for c in "!|$%")], axis=1)


def _distinct(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Text number of each distinct (text, hash)."""
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    return d[np.r_[True, (d[1:] != d[:-1]) | (x[1:] != x[:-1])]] if len(d) else d


def _featured(rows: DataFrame) -> DataFrame:
    """``(id, x)``: the features of every row's text."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column("text")):
                x = text_features(data, offs).astype(np.float32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), flat], names=["id", "x"])

    return rows.select("id", "text").mapInArrow(run, f"id {kind}, x array<float>")


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin number of each value, offset per feature: columns of a one-hot model."""
    width = max(len(e) for e in edges) + 1
    return np.stack([np.searchsorted(e, x[:, f], "right") + f * width for f, e in enumerate(edges)], axis=1)


def bin_edges(featured: DataFrame, bins: int) -> list[np.ndarray]:
    """Quantiles of each feature over all rows (``percentile_approx``, rank error a ten-thousandth)."""
    at = [i / bins for i in range(1, bins)]
    row = featured.agg(*(F.percentile_approx(F.col("x")[f], at, 10_000).alias(f"f{f}") for f in range(FEATURES))).first()
    return [np.unique(np.array(row[f"f{f}"] or [], np.float32)) for f in range(FEATURES)]


def _binned(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Blocks ``(rows, bins, trusted)`` of the rows ``(x, trusted)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(i, _BLOCK)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
                trusted = np.packbits(part.column("trusted").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([_bins(x, edges).astype(np.uint16).tobytes()]),
                                                  pa.array([trusted.tobytes()])], names=["rows", "bins", "trusted"])

    return rows.select("x", "trusted").mapInArrow(run, "rows long, bins binary, trusted binary")


def block_sums(bins: np.ndarray, trusted: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over rows of bin numbers: positives, loss as negative of the positives and of all rows, then three gradients
    (positives as positive, positives as negative, all as negative)."""
    z = w[bins].sum(axis=1) + w[-1]
    p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def grad(g, own):
        out = np.bincount(own.ravel(), np.repeat(g, own.shape[1]), len(w))
        out[-1] = g.sum()
        return out

    loss = np.logaddexp(0, z)
    return np.concatenate([[trusted.sum(), loss[trusted].sum(), loss.sum()], grad(p[trusted] - 1, bins[trusted]),
                           grad(p[trusted], bins[trusted]), grad(p, bins)])


def _summed(blocks: DataFrame, w: np.ndarray) -> np.ndarray:
    """``block_sums`` over all blocks: per task, then by place in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 + 3 * len(w))
        for batch in batches:
            for n, bins, trusted in zip(*(batch.column(c) for c in ("rows", "bins", "trusted"))):
                rows = np.frombuffer(bins.as_buffer(), np.uint16).reshape(-1, FEATURES).astype(np.int64)
                mark = np.unpackbits(np.frombuffer(trusted.as_buffer(), np.uint8), count=n.as_py()).astype(bool)
                total += block_sums(rows, mark, w)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "part"])

    got = blocks.mapInArrow(run, "at int, part double").groupBy("at").agg(F.sum("part").alias("part")).toArrow()
    out = np.zeros(3 + 3 * len(w))
    out[got["at"].to_numpy()] = got["part"].to_numpy()
    return out


def risk_gradient(sums: np.ndarray, rows: int, w: np.ndarray, prior: float, decay: float) -> np.ndarray:
    """Gradient of the non-negative risk from ``block_sums``; where the negative class's risk is below 0, its ascent."""
    n, lp, lu = sums[:3]
    plus, minus_p, minus_u = (sums[3 + i * len(w):3 + (i + 1) * len(w)] for i in range(3))
    back = minus_u / rows - prior * minus_p / n
    grad = prior * plus / n + back if lu / rows - prior * lp / n >= 0 else -back
    grad[:-1] += decay * w[:-1]
    return grad


def nnpu_fit(blocks: DataFrame, rows: int, prior: float, size: int, steps: int = 60, rate: float = 0.2, decay: float = 1e-4) -> np.ndarray:
    """Weights (bias last) by Adam on the non-negative risk of all rows with the logistic loss."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        grad = risk_gradient(_summed(blocks, w), rows, w, prior, decay)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        now = rate if t < 0.7 * steps else 0.3 * rate
        w = w - now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fit_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", prior: float | None = None, bins: int = 16) -> tuple[list[np.ndarray], np.ndarray]:
    """The model: bin edges and weights (bias last).  ``train`` is a condition on the id column of ``labels``."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train)
    n, ones = usable.agg(F.count("*"), F.sum(F.col(label_col).cast("int"))).first()
    if prior is None:
        prior = min(0.99, max(0.01, ((ones or 0) + 0.5) / (n + 1)))
    featured = materialize(spark, _featured(_rows(docs, id_col, text_col)), "quality-features")
    trusted = usable.where(F.col(label_col) == 1).select(F.col(id_col).alias("id"), F.lit(True).alias("trusted")).distinct()
    marked = featured.where("id is not null").join(trusted, "id", "left").select("x", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    marked = marked.unionByName(featured.where("id is null").select("x", F.lit(False).alias("trusted")))
    edges = bin_edges(featured, bins)
    size = FEATURES * (max(len(e) for e in edges) + 1)
    blocks = materialize(spark, _binned(marked, edges), "quality-bins")
    rows = blocks.agg(F.sum("rows")).first()[0] or 0
    nothing = np.zeros(size + 1)
    nothing[-1] = np.log(prior / (1 - prior))
    learn = bool(rows) and _summed(blocks, nothing)[0] > 0
    return edges, nnpu_fit(blocks, rows, prior, size) if learn else nothing


def _scores(texts, edges: list[np.ndarray], w: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after last, scores) of slices of a text column."""
    for i, j, data, offs in text_chunks(texts):
        z = w[_bins(text_features(data, offs).astype(np.float32), edges)].sum(axis=1) + w[-1]
        yield i, j, 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality",
                  id_col: str = "doc_id", text_col: str = "text", prior: float | None = None, bins: int = 16, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1), and the row's ``text_key`` if ``keyed``."""
    kind = docs.schema[id_col].dataType.simpleString()
    model = spark.sparkContext.broadcast(fit_quality(spark, docs, labels, train, label_col, id_col, text_col, prior, bins))
    src = _rows(docs, id_col, text_col)
    read = src.withColumn("text_key", text_key("text")) if keyed else src

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, score in _scores(batch.column("text"), *model.value):
                keys = [batch.column("text_key").slice(i, j - i)] if keyed else []
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array(score), *keys], names=["id", "score", "text_key"][:2 + keyed])

    return read.mapInArrow(run, f"id {kind}, score double" + ", text_key long" * keyed).withColumnRenamed("id", id_col)


def keep_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column, least: float, label_col: str = "quality",
                 id_col: str = "doc_id", text_col: str = "text", prior: float | None = None, bins: int = 16) -> DataFrame:
    """The rows of ``docs``, all columns, whose own score is ``least`` or more: filtered where they are read, no row is shuffled."""
    model = spark.sparkContext.broadcast(fit_quality(spark, docs, labels, train, label_col, id_col, text_col, prior, bins))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, score in _scores(batch.column(place), *model.value):
                yield batch.slice(i, j - i).filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)
