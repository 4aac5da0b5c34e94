"""Benchmark decontamination by winnowing.

Both sides are cut into words (A-Z lower-cased).  The hashes of all k-word
grams are winnowed: of every ``w`` consecutive hashes the smallest is kept, so
any two equal passages of ``k + w - 1`` words keep the same fingerprint.  With
``k + w - 1`` equal to the window length every shared window has a shared
fingerprint.  Items shorter than a window are one window of their own length
``L``; for these ``k = L, w = 1`` (every gram is kept).  Training fingerprints
are joined with the test fingerprints and each hit is extended to the windows
that cover it, which are confirmed on 128-bit hashes of whole windows.

The fingerprint join is a lookup in a sorted broadcast array while the test
side has at most ``max_broadcast`` fingerprints (16 bytes each), and a Spark join
beyond that; both give the same rows.

Rows: nulls and empty texts have no words (0 words, no items, clean).  A null
doc_id is a document like any other.  Repeated rows and rows that share a doc_id
each get their own result row.  An empty benchmark or table gives clean or no rows.  Only the
named id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import materialize, text_key
from revlens.llm.textops import ALNUM, grams, mix, segment_ranges, text_chunks, words

_U = np.uint64
_SALT = _U(0x9E3779B97F4A7C15)


def _window_hashes(h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window of ``length`` words."""
    return grams(h, length), grams(mix(h ^ _SALT), length)


def _winnow(g: np.ndarray, w: int) -> np.ndarray:
    """Positions of the (rightmost) smallest hash of every ``w`` consecutive ones, ascending, without repeats."""
    if len(g) <= w:
        return np.array([len(g) - 1 - int(np.argmin(g[::-1]))]) if len(g) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g[::-1], w)
    pos = len(g) - 1 - (np.arange(len(view)) + np.argmin(view, axis=1))
    return np.unique(pos)


def _all_fingerprints(h: np.ndarray, wo: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes kept in a batch; windows never cross texts.

    A stretch over two texts could only add positions, so the batch is winnowed
    as one array and grams that cross a border are dropped first by giving them the
    largest hash; a text with fewer grams than ``w`` keeps its smallest.
    """
    g = grams(h, k)
    n = np.maximum(np.diff(wo) - k + 1, 0)
    keep = []
    long = n >= w
    at = segment_ranges(wo[:-1][long], n[long])
    if len(at):
        if w == 1:
            keep.append(at)
        else:
            inner = g[at]
            best = inner.copy()
            where = np.zeros(len(inner), np.int64)
            for d in range(1, w):
                nxt = inner[d:]
                cur = best[:-d]
                less = nxt <= cur
                np.copyto(cur, nxt, where=less)
                where[:-d][less] = d
            first = np.r_[0, np.cumsum(n[long])[:-1]]
            lead = segment_ranges(first, n[long] - w + 1)
            mark = np.zeros(len(inner), bool)
            mark[lead + where[lead]] = True
            keep.append(at[mark])
    for i in np.flatnonzero((n > 0) & ~long):
        keep.append(wo[i] + _winnow(g[wo[i]:wo[i] + n[i]], w))
    at = np.concatenate(keep) if keep else np.zeros(0, np.int64)
    return at, g[at] if len(at) else np.zeros(0, _U)


def _plan(window: int, lengths: list[int], k: int) -> list[tuple[int, int, int]]:
    """``(window length, k, w)`` for the full window and each shorter item length."""
    return [(n, k, window - k + 1) if n == window else (n, n, 1) for n in lengths]


def benchmark_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``(item, length, w1, w2, gram hashes)``: every window of every item with the hashes of its grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item")
            for i, _, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, ALNUM)
                for r in range(len(wo) - 1):
                    own = h[wo[r]:wo[r + 1]]
                    n = min(window, len(own))
                    if n:
                        a, b = _window_hashes(own, n)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[i + r].as_py()] * len(a), pa.string()), pa.array(np.full(len(a), n, np.int32)),
                             pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                             pa.array([own[s:s + n].tobytes() for s in range(len(a))], pa.binary())],
                            names=["item", "length", "w1", "w2", "word_hashes"])

    return (items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
            .mapInArrow(run, "item string, length int, w1 long, w2 long, word_hashes binary"))


def _fingerprints_of(windows: DataFrame, window: int, k: int) -> DataFrame:
    """Distinct ``(length, hash)`` fingerprints of the benchmark windows (each window is winnowed on its own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_n, out_h = [], []
            for n, b in zip(batch.column("length").to_pylist(), batch.column("word_hashes").to_pylist()):
                _, kk, w = _plan(window, [n], k)[0]
                g = grams(np.frombuffer(b, _U), kk)
                out_h.append(g[_winnow(g, w)])
                out_n.append(np.full(len(out_h[-1]), n, np.int32))
            if out_h:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_n)), pa.array(np.concatenate(out_h).view(np.int64))], names=["length", "fp"])

    return windows.select("length", "word_hashes").distinct().mapInArrow(run, "length int, fp long").distinct()


def _around(h: np.ndarray, lo: int, hi: int, at: np.ndarray, length: int, k: int):
    """Starts and hashes of the windows of a text (words lo..hi) that cover a fingerprint hit."""
    first = np.maximum(at - (length - k), lo)
    last = np.minimum(at, hi - length)
    ok = last >= first
    starts = np.unique(segment_ranges(first[ok], last[ok] - first[ok] + 1))
    if not len(starts):
        return starts, None, None
    used = np.unique((starts[:, None] + np.arange(length)).ravel())
    rank = np.searchsorted(used, starts)
    a, b = _window_hashes(h[used], length)
    return starts, a[rank], b[rank]


_DOC = "id string, text_key long, n_words long, hits array<struct<start:int,length:int,w1:long,w2:long>>"


def _hits_type() -> pa.DataType:
    return pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())]))


def _doc_batch(ids, keys, n_words, hits) -> pa.RecordBatch:
    """hits: for each text a list of (starts, length, w1, w2) arrays."""
    counts = [sum(len(x[0]) for x in own) for own in hits]
    flat = [x for own in hits for x in own]
    cat = lambda i, t: np.concatenate([x[i] for x in flat]).astype(t) if flat else np.zeros(0, t)
    size = np.concatenate([np.full(len(x[0]), x[1], np.int32) for x in flat]) if flat else np.zeros(0, np.int32)
    values = pa.StructArray.from_arrays(
        [pa.array(cat(0, np.int32)), pa.array(size), pa.array(cat(2, _U).view(np.int64)), pa.array(cat(3, _U).view(np.int64))],
        fields=list(_hits_type().value_type))
    offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    return pa.RecordBatch.from_arrays([ids, keys, pa.array(n_words), pa.ListArray.from_arrays(offsets, values)],
                                      names=["id", "text_key", "n_words", "hits"])


def _scan(docs: DataFrame, plan, table: dict[int, np.ndarray]) -> DataFrame:
    """One pass: fingerprints, lookup in the sorted test fingerprints, windows around the hits."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, ALNUM)
                hits: list[list] = [[] for _ in range(j - i)]
                for length, k, w in plan:
                    at, fp = _all_fingerprints(h, wo, k, w)
                    pos = np.searchsorted(known[length], fp)
                    pos[pos == len(known[length])] = 0
                    at = at[known[length][pos] == fp] if len(known[length]) else at[:0]
                    doc = np.searchsorted(wo, at, "right") - 1
                    for r in np.unique(doc):
                        s, a, b = _around(h, wo[r], wo[r + 1], at[doc == r], length, k)
                        if len(s):
                            hits[r].append((s - wo[r], length, a, b))
                yield _doc_batch(batch.column("id").slice(i, j - i), batch.column("text_key").slice(i, j - i), np.diff(wo), hits)

    return docs.mapInArrow(run, _DOC)


def _scan_joined(spark: SparkSession, docs: DataFrame, plan, fps: DataFrame) -> DataFrame:
    """The same rows by Spark joins: fingerprint rows, semi-join, positions back to their texts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, ALNUM)
                for length, k, w in plan:
                    at, fp = _all_fingerprints(h, wo, k, w)
                    doc = np.searchsorted(wo, at, "right") - 1
                    take = pa.array(doc + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(take), batch.column("text_key").take(take),
                         pa.array(np.full(len(at), length, np.int32)), pa.array((at - wo[doc]).astype(np.int32)), pa.array(fp.view(np.int64))],
                        names=["id", "text_key", "length", "at", "fp"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kk = {length: k for length, k, _ in plan}
        for batch in batches:
            places = batch.column("places").to_pylist()
            for i, j, data, offs in text_chunks(batch.column("text")):
                h, wo = words(data, offs, ALNUM)
                hits: list[list] = [[] for _ in range(j - i)]
                for r in range(j - i):
                    by: dict[int, list[int]] = {}
                    for p in places[i + r] or []:
                        by.setdefault(p["length"], []).append(p["at"])
                    for length, at in sorted(by.items()):
                        s, a, b = _around(h, wo[r], wo[r + 1], wo[r] + np.unique(at), length, kk[length])
                        if len(s):
                            hits[r].append((s - wo[r], length, a, b))
                yield _doc_batch(batch.column("id").slice(i, j - i), batch.column("text_key").slice(i, j - i), np.diff(wo), hits)

    found = (docs.mapInArrow(emit, "id string, text_key long, length int, at int, fp long")
             .join(fps, ["length", "fp"], "left_semi")
             .groupBy("id", "text_key").agg(F.collect_set(F.struct("length", "at")).alias("places")))
    same = docs["id"].eqNullSafe(found["id"]) & (docs["text_key"] == found["text_key"])
    return (docs.join(found, same, "left").select(docs["id"], docs["text_key"], "text", "places").mapInArrow(extend, _DOC))


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 13, k: int = 9,
                  max_broadcast: int = 2_000_000, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit (words inside benchmark windows), items (sorted ids), spans, and the row's ``text_key`` if ``keyed``.

    ``spans`` are the merged hit ranges (start word, end word).  The id keeps
    its type; ``items`` are strings.
    """
    kind = docs.schema[id_col].dataType
    windows = materialize(spark, benchmark_windows(items, item_id, item_text, window), "bench")
    fps = _fingerprints_of(windows, window, k)
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most `window` values
    plan = _plan(window, lengths, k)
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.select("id", text_key("text").alias("text_key"), "text")
    head = fps.limit(max_broadcast + 1).toPandas()
    if len(head) <= max_broadcast:
        table = {n: np.sort(head["fp"][head["length"] == n].to_numpy(np.int64).view(_U)) for n in lengths}
        scanned = _scan(src, plan, table)
    else:
        scanned = _scan_joined(spark, src, plan, fps)
    scanned = materialize(spark, scanned, "winnowed")

    hit = scanned.where(F.size("hits") > 0).select("id", "text_key", F.explode("hits").alias("h"))
    keys = windows.select("length", "w1", "w2").distinct()
    sure = (hit.select("id", "text_key", "h.start", "h.length", "h.w1", "h.w2").distinct()
            .join(keys, ["length", "w1", "w2"]))
    by = Window.partitionBy("id", "text_key").orderBy("start", "end")
    run = (sure.select("id", "text_key", "start", (F.col("start") + F.col("length")).alias("end"))
           .withColumn("before", F.coalesce(F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    fresh = run.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before")))
    per_doc = fresh.groupBy("id", "text_key").agg(
        F.sum("fresh").cast("long").alias("n_hit"),
        F.array_sort(F.collect_list(F.struct(F.greatest("start", "before").alias("start"), "end"))).alias("spans"))
    per_doc = per_doc.withColumn("spans", F.filter("spans", lambda s: s["end"] > s["start"]))
    named = (sure.select("id", "text_key", "length", "w1", "w2").distinct()
             .join(windows.select("length", "w1", "w2", "item").distinct(), ["length", "w1", "w2"])
             .groupBy("id", "text_key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    base = scanned.select("id", "text_key", "n_words").alias("d")
    same = lambda o: F.col("d.id").eqNullSafe(F.col(f"{o}.id")) & (F.col("d.text_key") == F.col(f"{o}.text_key"))
    return (base.join(per_doc.alias("p"), same("p"), "left").join(named.alias("n"), same("n"), "left")
            .select(F.col("d.id").cast(kind).alias(id_col), "d.n_words", F.coalesce("p.n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("n.items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("p.spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"), *["d.text_key"] * keyed))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """The contract's rule: at least one word and at least a twentieth of the words is hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
