"""Ranked lexical search by norm buckets (maximum inner product with pruning), exact in integers.

A document is the vector of its impacts: for each term that some item asks for, the term's integer weight times the document's
integer saturated frequency.  An item is a 0/1 vector over its terms, and its score is the inner product, a sum of 64-bit integers.

1. One pass over the whole texts hashes words (64 bits) and keeps, per document, its number of terms and the frequencies of the
   items' terms.  Document count, total length and document frequencies are Spark sums over all of it.
2. Impact vectors are range-partitioned and sorted by their length (Euclidean norm), longest first; (norm, row hash) is the order, so that copies
   that fill a third of the table spread.  A norm bucket is a power of ``2 ** (1 / steps)``.
3. The buckets run in rounds from the longest vectors down.  After each round the ``k``-th best score so far is an item's threshold.
   Within a round, a task takes its vectors in slices of like length.  Cauchy-Schwarz skips a slice for an item when
   sqrt(terms) times the slice's longest vector can't reach the threshold.  Inside a slice, the rarest terms are read from the
   slice's inverted lists first; what the others can still add is bounded by Cauchy-Schwarz on the rest of the vector and by
   the largest coordinate of each term in the slice.  Documents that the bounds leave are rescored exactly in integers.  The bounds are
   never below the true score (they carry a margin for rounding), and a document that ties the threshold is kept, so the result is exact.
4. A task keeps the ``k`` best per item; Spark merges the tasks' lists.

Items are taken in blocks of at most ``max_terms`` terms (the size of what is sent to the tasks); each block runs over
all documents.  Items that share an item_id, also a null one, are one item with the terms of all.

Rows: a null text has no terms; documents without terms aren't counted; repeated rows are ranked each; null ids come
last among equal scores.  An empty table or an item without terms gives no rows.  Texts are read whole.  Only the named id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import materialize
from revlens.llm.textops import ALNUM, text_chunks, words

K = 50
SCALE = 1_000_000_000
SLICE = 4096  # vectors whose lengths are bounded together


def term_weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N+2)/(2df+1))), in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def hash_words(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets of the rows) of slices of a text column."""
    for i, _, data, offs in text_chunks(col):
        h, at = words(data, offs, ALNUM)
        yield i, h, at


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, term)``: the distinct terms (as word hashes) of each item."""

    def run(batches):
        for b in batches:
            ids, out_id, out_term = b.column(0), [], []
            for i, h, at in hash_words(b.column(1)):
                out_id.append(np.repeat(np.arange(i, i + len(at) - 1), np.diff(at)))
                out_term.append(h)
            row = np.concatenate(out_id) if out_id else np.zeros(0, np.int64)
            term = np.concatenate(out_term) if out_term else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(term.view(np.int64))], ["item_id", "term"])

    kind = items.schema[id_col].dataType.simpleString()
    src = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"item_id {kind}, term long").distinct()


def term_counts(docs: DataFrame, vocabulary: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tf)`` of every row: its number of terms, and numbers and frequencies of the vocabulary's terms in it.

    ``vocabulary``: sorted word hashes; a term's number is its place."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        vocab = shared.value
        for b in batches:
            for i, h, at in hash_words(b.column(1)):
                rows = len(at) - 1
                n = np.diff(at)
                place = np.searchsorted(vocab, h)
                known = np.flatnonzero(vocab[np.minimum(place, len(vocab) - 1)] == h) if len(vocab) else np.zeros(0, np.int64)
                pair, tf = np.unique(np.repeat(np.arange(rows), n)[known] * (len(vocab) + 1) + place[known], return_counts=True)
                row, term = pair // (len(vocab) + 1), pair % (len(vocab) + 1)
                offs = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, rows), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(offs, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offs, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tf"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tf array<int>")


def document_frequencies(counts: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents that hold each term: summed per task, then by Spark."""

    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            df += np.bincount(_flat(b.column(0)), minlength=n_terms)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df[term])], ["term", "df"])

    got = counts.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[got["term"].to_numpy()] = got["df"].to_numpy()
    return df


def _flat(col) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False)


def impact_vectors(counts: DataFrame, weight: np.ndarray, n_docs: int, total: int) -> DataFrame:
    """``(doc_id, norm, terms, impact)`` of the documents that have an impact; a vector's norm is its Euclidean length."""
    shared = counts.sparkSession.sparkContext.broadcast(weight)
    kind = counts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        w = shared.value
        for b in batches:
            terms, tf, n = _flat(b.column(2)), _flat(b.column(3)).astype(np.int64), b.column(1).to_numpy()
            size = np.diff(b.column(2).offsets.to_numpy())
            m = 50 + (50 * n * n_docs) // max(1, total)
            impact = w[terms] * ((SCALE * tf) // (1000 * tf + 20 * np.repeat(m, size)))
            keep = impact > 0
            row = np.repeat(np.arange(len(n)), size)[keep]
            terms, impact = terms[keep], impact[keep]
            norm = np.sqrt(np.bincount(row, impact.astype(float) ** 2, len(n)))
            offs = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(norm), pa.ListArray.from_arrays(pa.array(offs), pa.array(terms)),
                pa.ListArray.from_arrays(pa.array(offs), pa.array(impact))], ["doc_id", "norm", "terms", "impact"])

    got = counts.mapInArrow(run, f"doc_id {kind}, norm double, terms array<int>, impact array<long>")
    return got.where("norm > 0")


class _Best:
    """The ``k`` best (score, row) of each item that a task has seen, and the score that a further row must reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()
        self.score = [np.zeros(0, np.int64)] * len(floor)
        self.id = [[] for _ in floor]

    def add(self, item: int, score: np.ndarray, ids: list) -> None:
        score = np.r_[self.score[item], score]
        ids = self.id[item] + ids
        # rows that tie the k-th best stay until Spark ranks them, unless a smaller id is known
        order = sorted(range(len(ids)), key=lambda i: (-score[i], ids[i] is None, ids[i] if ids[i] is not None else 0))[:self.k]
        self.score[item], self.id[item] = score[order], [ids[i] for i in order]
        if len(order) == self.k:
            self.floor[item] = max(self.floor[item], self.score[item][-1])


def scan_slice(norm, offs, terms, impact, ids, items: list[np.ndarray], rarity: np.ndarray, best: _Best, n_terms: int) -> None:
    """Offer the vectors of a slice (lengths descending) to every item."""
    rows = len(norm)
    row = np.repeat(np.arange(rows), np.diff(offs))
    by_term = np.argsort(terms, kind="stable")
    lists = np.searchsorted(terms[by_term], np.arange(n_terms + 1))  # inverted lists of the slice
    row, value = row[by_term], impact[by_term]
    top = np.zeros(n_terms, np.int64)  # largest coordinate of each term
    held = np.flatnonzero(np.diff(lists))
    top[held] = np.maximum.reduceat(value, lists[held]) if len(held) else 0
    square = norm * norm
    for item, asked in enumerate(items):
        floor = max(1, int(best.floor[item]))
        if math.sqrt(len(asked)) * norm[0] * (1 + 1e-9) < floor:
            continue  # Cauchy-Schwarz: no vector of the slice is long enough
        asked = asked[top[asked] > 0]
        if int(top[asked].sum()) < floor:
            continue  # not even the largest coordinates together
        asked = asked[np.argsort(rarity[asked], kind="stable")]
        # rarest terms until the others alone can't reach the threshold: every survivor holds one of them
        rest = np.r_[np.cumsum(top[asked][::-1])[::-1][1:], 0]
        first = int(np.argmax(rest < floor)) + 1
        span = np.concatenate([np.arange(lists[t], lists[t + 1]) for t in asked[:first]])
        r, v = row[span], value[span]
        part = np.bincount(r, v, rows)
        seen = np.flatnonzero(np.bincount(r, minlength=rows))
        left = np.maximum(0.0, square[seen] - np.bincount(r, v.astype(float) ** 2, rows)[seen])
        bound = part[seen] + np.minimum(float(rest[first - 1]), np.sqrt((len(asked) - first) * left * (1 + 1e-9)))
        seen = seen[bound * (1 + 1e-9) >= floor]
        if not len(seen):
            continue
        score = np.zeros(rows, np.int64)
        for t in asked:  # exact, in integers; a vector holds a term once
            at = slice(lists[t], lists[t + 1])
            score[row[at]] += value[at]
        seen = seen[score[seen] >= floor]
        if len(seen):
            best.add(item, score[seen], [ids[i] for i in seen.tolist()])


def search_vectors(vectors: DataFrame, items: list[np.ndarray], df: np.ndarray, floor: np.ndarray, k: int) -> DataFrame:
    """``(item, doc_id, score)``: the ``k`` best of each item in each task, none below ``floor``."""
    sc = vectors.sparkSession.sparkContext
    shared = sc.broadcast((items, df, floor))
    field = vectors.schema["doc_id"].dataType.simpleString()

    def run(batches):
        asked, rarity, least = shared.value
        best = _Best(least, k)
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for i in range(0, b.num_rows, SLICE):
                s = b.slice(i, SLICE)
                lists = s.column(2)
                offs = lists.offsets.to_numpy()
                scan_slice(s.column(1).to_numpy(), offs - offs[0], _flat(lists), _flat(s.column(3)), s.column(0).to_pylist(),
                           asked, rarity, best, len(rarity))
        if kind is not None:
            n = [len(x) for x in best.id]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(len(n)), n).astype(np.int32)), pa.array([d for x in best.id for d in x], kind),
                pa.array(np.concatenate(best.score) if n else [], pa.int64())], ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, f"item int, doc_id {field}, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def norm_bucket(norm: Column, steps: int) -> Column:
    return F.floor(F.log2(norm) * steps).cast("int")


def _rounds(sizes: dict[int, int], shares: tuple[float, ...]) -> list[tuple[int, int]]:
    """Ranges of norm buckets (low, high), longest first, that hold about these shares of the vectors, and the rest."""
    total, seen, out, high = sum(sizes.values()), 0, [], None
    goals = list(shares)
    for b in sorted(sizes, reverse=True):
        high = b if high is None else high
        seen += sizes[b]
        if goals and seen >= goals[0] * total:
            out.append((b, high))
            goals = [g for g in goals if seen < g * total]
            high = None
    if high is not None:
        out.append((min(sizes), high))
    return out


def _item_blocks(sizes: list[int], max_terms: int) -> list[list[int]]:
    blocks, now = [[]], 0
    for i, n in enumerate(sizes):
        if blocks[-1] and now + n > max_terms:
            blocks.append([])
            now = 0
        blocks[-1].append(i)
        now += n
    return blocks


def ranked_search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", max_terms: int = 1_000_000, steps: int = 2,
                  shares: tuple[float, ...] = (0.02, 0.2)) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` highest-scoring documents, score above 0, equal scores by ascending id."""
    terms = materialize(spark, item_terms(items, item_col, item_text_col), "item-terms")
    sizes = [tuple(r) for r in terms.groupBy("item_id").count().orderBy("item_id").collect()]  # the items, not the documents
    names = spark.createDataFrame([(i, s[0]) for i, s in enumerate(sizes)], f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}")
    found = None
    for block in _item_blocks([s[1] for s in sizes], max_terms):
        own = terms.join(names.where(F.col("item").isin(block)), terms["item_id"].eqNullSafe(names["item_id"])).select("item", "term").toArrow()
        item, term = own["item"].to_numpy(), own["term"].to_numpy().view(np.uint64)
        vocab = np.unique(term)
        number = np.searchsorted(vocab, term)
        asked = [number[item == i] for i in block]
        got = _search_block(spark, docs, vocab, asked, k, id_col, text_col, steps, shares)
        if got is None:
            continue
        part = got.join(F.broadcast(spark.createDataFrame(list(enumerate(block)), "item int, all int")), "item").select(
            F.col("all").alias("item"), "rank", "doc_id", "score")  # as many rows as items in the block
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = docs.schema[id_col].dataType.simpleString()
        found = spark.createDataFrame([], f"item int, rank int, doc_id {kind}, score long")
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _search_block(spark, docs, vocab, asked, k, id_col, text_col, steps, shares) -> DataFrame | None:
    counts = materialize(spark, term_counts(docs, vocab, id_col, text_col), "term-counts")
    n_docs, total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not len(vocab):
        return None
    df = document_frequencies(counts, len(vocab))
    vectors = impact_vectors(counts, term_weight(n_docs, df), n_docs, total)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    vectors = vectors.withColumns({"order": F.xxhash64("doc_id", "terms", "impact"), "place": F.monotonically_increasing_id()})
    keys = [F.desc("norm"), "order", "place"]  # copies that share a norm still spread
    vectors = vectors.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("order", "place")
    vectors = materialize(spark, vectors.withColumn("bucket", norm_bucket(F.col("norm"), steps)), "vectors")
    sizes = {r["bucket"]: r["count"] for r in vectors.groupBy("bucket").count().collect()}  # a few hundred powers at most
    if not sizes:
        return None
    floor, found = np.zeros(len(asked), np.int64), None
    for low, high in _rounds(sizes, shares):
        part = vectors.where(F.col("bucket").between(low, high)).select("doc_id", "norm", "terms", "impact")
        got = search_vectors(part, asked, df, floor, k)
        got = got if found is None else found.unionByName(got)
        found = materialize(spark, _best(got, k).select("item", "doc_id", "score"), "best")
        for r in found.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect():
            floor[r["item"]] = r["least"]
    return _best(found, k).select("item", "rank", "doc_id", "score")
