"""Spelling variants by an FM-index over the delimited vocabulary, searched from either half.

1. Vocabulary: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z lower-cased, counted per task before
   they move.  Where the contract's hash of (id, run) says so, a run loses a letter first.
2. Two words are near at exactly one inserted, deleted or replaced code point.  The edit lies in one half of the
   word, so the near word has the other half unchanged: as its beginning, or as its end.  Each word is
   read twice, from its start (left half exact) and from its end (right half exact).
3. A word is filed under the halves by which a word of its length, one more or one less can ask for it: two per reading.  Halves
   are dealt to blocks of about ``block_rows`` by hash; a half with more words than that (a few letters can start only so many words
   of its length) is salted over several blocks, each word in one of them and each question sent to all.
4. Each block is one FM-index: the words of the block, delimited, their suffixes ranked, and the letter before each.
   A question narrows the interval of suffix ranks by the letters of its exact half, then goes on across the other half
   with at most one error, all questions of one length at once.  What remains at the closing delimiter is a near word.
   The index of a block answers in one reading direction; both directions together make the search scheme.
5. A pair that both halves would find (its edit lies on the seam) counts where it is read from its start.

Rows: a null text has no runs, a null id counts as the empty text in the hash, repeated rows count each, an empty table gives no
rows.  Texts are read whole, very long ones run by run.  Only the named id and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import materialize

MIN_LETTERS = 7
MIN_COUNT = 2
FORM_TIMES = 10
DROP_EVERY = 31
_LONG = 1 << 22  # code points from which runs are read one by one
_FLUSH = 1 << 18  # distinct words a task holds
_ASK = 4096  # questions searched at once
_UPPER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------ vocabulary
def count_words(batches: Iterator[pa.RecordBatch], min_letters: int) -> Iterator[pa.RecordBatch]:
    """``(word, n)`` of the (id, text) rows, summed within a task as far as memory allows."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{min_letters},}}")  # shorter runs can't give a word
    words: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            own = Counter(runs.findall(text) if len(text) < _LONG else (m.group() for m in runs.finditer(text)))
            for run, n in own.items():
                run = run.lower() if run.isascii() else run.translate(_UPPER)
                h = zlib.crc32(f"{doc}:{run}".encode())
                if h % DROP_EVERY == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < min_letters:
                        continue
                words[run] += n
            if len(words) > _FLUSH:
                yield out()
                words.clear()
    yield out()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: words of at least ``min_letters`` code points found ``min_count`` times or more."""
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    got = src.mapInArrow(lambda it: count_words(it, min_letters), "word string, n long")
    return got.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -------------------------------------------------------------------- FM-index
class FmIndex:
    """FM-index over distinct strings, each stored backwards between delimiters, so that a search reads a string from its start."""

    def __init__(self, strings: list[str]):
        lengths = np.array([len(s) for s in strings], np.int64)
        flat = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        self.letters, dense = np.unique(flat, return_inverse=True)
        n = len(flat) + len(strings) + 2
        self.n1 = n + 1
        # delimiter 1 at the start and after each string, the end sign 0 last; letters count from 2
        text = np.ones(n, np.int64)
        text[-1] = 0
        starts = np.r_[0, np.cumsum(lengths)]
        word = np.repeat(np.arange(len(strings)), lengths)
        inside = np.arange(len(flat)) - starts[word]
        text[1 + starts[word] + word + lengths[word] - 1 - inside] = dense + 2
        self.delimiters = np.r_[0, 1 + starts[1:] + np.arange(len(strings))]
        self.sa = self._suffix_ranks(text)
        before = text[self.sa - 1]
        self.bwt = before
        order = np.argsort(before, kind="stable")
        self.keys = before[order] * self.n1 + order  # the letter before each suffix, then its rank
        self.n_letters = len(self.letters)

    @staticmethod
    def _suffix_ranks(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling."""
        n, rank, k = len(text), text.copy(), 1
        while True:
            key = rank * (n + 2)
            key[:n - k] += rank[k:] + 1
            sa = np.argsort(key, kind="stable")
            ordered = key[sa]
            new = np.r_[0, np.cumsum(ordered[1:] != ordered[:-1])]
            rank = np.empty(n, np.int64)
            rank[sa] = new
            if new[-1] == n - 1:
                return sa
            k *= 2

    def encode(self, strings: list[str], length: int) -> np.ndarray:
        """Letters of strings of one length as a matrix; all letters are known to the index."""
        flat = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        return (np.searchsorted(self.letters, flat) + 2).reshape(len(strings), length)

    def _step(self, c, lo, hi):
        """Intervals of suffix ranks after one more letter."""
        base = c * self.n1
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def _children(self, q, lo, hi):
        """Every letter that may come next, with its interval."""
        size = hi - lo
        wide = size > self.n_letters
        small = np.flatnonzero(~wide)
        count = size[small]
        at = np.repeat(lo[small] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        pair = np.unique(np.repeat(small, count) * (self.n_letters + 2) + self.bwt[at])
        big = np.flatnonzero(wide)
        pair = np.r_[pair, (big[:, None] * (self.n_letters + 2) + np.arange(2, self.n_letters + 2)).ravel()]
        state, c = pair // (self.n_letters + 2), pair % (self.n_letters + 2)
        state, c = state[c >= 2], c[c >= 2]
        nlo, nhi = self._step(c, lo[state], hi[state])
        ok = nlo < nhi
        return q[state[ok]], c[ok], nlo[ok], nhi[ok]

    def near(self, seq: np.ndarray, exact: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``seq``, string) pairs at exactly one edit whose first ``exact`` letters agree; each pair once."""
        rows, length = seq.shape
        q = np.arange(rows)
        lo = np.full(rows, np.searchsorted(self.keys, self.n1))  # all suffixes that start with a delimiter
        hi = np.full(rows, np.searchsorted(self.keys, 2 * self.n1))
        for t in range(exact):
            lo, hi = self._step(seq[q, t], lo, hi)
            q, lo, hi = _those(lo < hi, q, lo, hi)
        eq, elo, ehi = (np.zeros(0, np.int64),) * 3  # one error made
        for t in range(exact, length + 1):
            cq, c, clo, chi = self._children(q, lo, hi)
            if t == length:
                eq, elo, ehi = np.r_[eq, cq], np.r_[elo, clo], np.r_[ehi, chi]  # one letter more at the end
                break
            same = seq[cq, t] == c
            more = _those(~same, cq, clo, chi)  # one letter more here; before an equal letter it comes later
            skip = q[seq[q, t] != seq[q, t + 1]] if t + 1 < length else q  # of equal letters the last one goes
            less = _those(np.isin(q, skip), q, lo, hi)
            eq, elo, ehi = np.r_[eq, more[0]], np.r_[elo, more[1]], np.r_[ehi, more[2]]
            elo, ehi = self._step(seq[eq, t], elo, ehi)
            eq, elo, ehi = _those(elo < ehi, eq, elo, ehi)
            eq, elo, ehi = np.r_[eq, more[0], less[0]], np.r_[elo, more[1], less[1]], np.r_[ehi, more[2], less[2]]
            q, lo, hi = _those(same, cq, clo, chi)
        elo, ehi = self._step(np.ones(len(eq), np.int64), elo, ehi)
        eq, elo = _those(elo < ehi, eq, elo)
        string = np.searchsorted(self.delimiters, self.sa[elo])
        pair = np.unique(eq * len(self.delimiters) + string)
        return pair // len(self.delimiters), pair % len(self.delimiters)


def _those(keep, *arrays):
    return tuple(a[keep] for a in arrays)


# ------------------------------------------------------------------ one block
FOUND = "word string, near long, best_n long, best string"
_FOUND_ARROW = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def search_block(rows: pa.Table) -> pa.Table:
    """Near words of the questions of one block.

    ``rows``: reading (0 from the start, 1 from the end), text as read, class, n, filed, asks.  A near word counts only within the
    question's class, so that blocks that share a word don't find it twice."""
    texts = rows["text"].to_pylist()
    names, place = {}, np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        place[i] = names.setdefault(t, len(names))
    strings = list(names)
    classes, cls = np.unique(rows["class"].to_numpy(), return_inverse=True)
    n, reading = rows["n"].to_numpy(), rows["reading"].to_numpy()
    filed, asks = rows["filed"].to_numpy(zero_copy_only=False), rows["asks"].to_numpy(zero_copy_only=False)
    member = place[filed] * len(classes) + cls[filed]
    by_member = np.argsort(member)
    member, member_n = member[by_member], n[filed][by_member]

    index = FmIndex(strings)
    lengths = np.array([len(t) for t in texts])
    out: list[tuple] = []
    for length in np.unique(lengths[asks]).tolist():
        for from_end in (0, 1):
            asked = np.flatnonzero(asks & (lengths == length) & (reading == from_end))
            exact = length - length // 2 if from_end else length // 2
            for i in range(0, len(asked), _ASK):
                part = asked[i:i + _ASK]
                q, s = index.near(index.encode([texts[j] for j in part], length), exact)
                q = part[q]
                key = s * len(classes) + cls[q]
                at = np.minimum(np.searchsorted(member, key), len(member) - 1)
                q, s, near_n = _those(member[at] == key, q, s, member_n[at])
                best: dict[int, list] = {}
                for j, k, m in zip(q.tolist(), s.tolist(), near_n.tolist()):
                    other = strings[k]
                    if from_end:
                        other = other[::-1]
                        if other.startswith(texts[j][::-1][:length // 2]):
                            continue  # found from the start as well
                    got = best.get(j)
                    if got is None:
                        best[j] = [1, -m, other]
                    else:
                        got[0] += 1
                        got[1:] = min(got[1:], [-m, other])
                out += [(texts[j][::-1] if from_end else texts[j], c, -m, w) for j, (c, m, w) in best.items()]
    columns = list(zip(*out)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW)], schema=_FOUND_ARROW)


# --------------------------------------------------------------------- groups
def near_words(spark: SparkSession, words: DataFrame, block_rows: int = 40_000, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``(word, near, best_n, best)`` of the words that have near words; ``words`` is ``(word, n)`` with distinct words."""
    size = F.char_length("word")
    half = lambda n: F.floor(n / 2)
    front = [half(size), half(size + 1), F.when(size > min_letters, half(size - 1)).otherwise(half(size))]
    back = [half(size + 1), half(size + 2), F.when(size > min_letters, half(size)).otherwise(half(size + 1))]
    readings = [words.select("n", F.lit(i).alias("reading"), text.alias("text"), keys[0].alias("own"), F.explode(F.array_distinct(F.array(*keys))).alias("length"))
                for i, (text, keys) in enumerate(((F.col("word"), front), (F.reverse("word"), back)))]
    rows = readings[0].unionByName(readings[1])
    rows = rows.select("reading", "text", "n", (F.col("own") == F.col("length")).alias("asks"),
                       F.xxhash64("reading", F.substring("text", F.lit(1), F.col("length").cast("int"))).alias("half"))
    rows = materialize(spark, rows, "halves")
    crowd = materialize(spark, rows.groupBy("half").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_rows)
                        .select("half", F.ceil(F.col("rows") / block_rows).cast("int").alias("salts")), "crowded")
    rows = rows.join(crowd, "half", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    own = F.pmod(F.xxhash64("text"), F.col("salts")).cast("int")
    every = F.sequence(F.lit(0), F.col("salts") - 1)
    rows = rows.withColumn("own", own).withColumn("salt", F.explode(F.when(F.col("asks"), every).otherwise(F.array("own"))))
    blocks = max(1, -(-words.count() * 4 // block_rows))
    rows = rows.select("reading", "text", "n", "asks", (F.col("salt") == F.col("own")).alias("filed"), F.xxhash64("half", "salt").alias("class"))
    rows = rows.withColumn("block", F.pmod(F.col("class"), F.lit(blocks)))
    found = rows.groupBy("block").applyInArrow(search_block, FOUND)
    # largest n first, then the smallest word: the least of (-n, word)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("best")).select(
        "word", "near", (-F.col("best")["n"]).alias("best_n"), F.col("best")["word"].alias("best"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: the last word of each chain, by pointer doubling.

    A form is ``FORM_TIMES`` as frequent, so chains are as long as the logarithm of the largest count and rounds as that one's."""
    cur = materialize(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(spark, cur.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                        F.col("next").isNotNull().alias("on")), "roots")
        cur = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return cur


def variant_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = 40_000) -> DataFrame:
    """One row per vocabulary word: word, form, root, n, n_near, form_n."""
    words = materialize(spark, vocabulary(docs, id_col, text_col), "vocabulary")
    near = materialize(spark, near_words(spark, words, block_rows), "near-words")
    is_form = F.col("best_n") >= FORM_TIMES * F.col("n")
    got = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"))
    got = materialize(spark, got, "forms")
    ends = roots(spark, got.where("form is not null").select("word", "form"))
    return got.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
