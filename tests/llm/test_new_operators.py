"""Hash tree, FM-index variants and norm-bucket search against brute force, with nulls, ties, repeated rows and empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from revlens.llm import fm_variants, hash_tree, norm_buckets
from revlens.session import scratch_path

SCHEMA = "doc_id long, text string, shard string, slot int, part int, row string"


# ------------------------------------------------------------------ hash tree
def _shards(spark, tree, n=4000):
    ids = spark.range(n).select(F.col("id").alias("doc_id"))
    return {r.doc_id: r.s for r in ids.select("doc_id", hash_tree.shard_of(F.col("doc_id"), tree).alias("s")).collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before = _shards(spark, hash_tree.Tree(37))
    for n in (38, 39, 40, 41):
        after = _shards(spark, hash_tree.Tree(n))
        moved = {i for i in before if before[i] != after[i]}
        assert moved and {after[i] for i in moved} == {n - 1}
        assert len(moved) < 3 * len(before) / n
        before = after
    share = Counter(before.values())
    assert set(share) == set(range(41)) and max(share.values()) < 2 * len(before) / 41


def test_weights_move_rows_only_in_their_subtree(spark):
    even = _shards(spark, hash_tree.Tree(40))
    lighter = _shards(spark, hash_tree.Tree(40, weights={7: 0.5}))
    moved = [i for i in even if even[i] != lighter[i]]
    assert moved and {even[i] for i in moved} == {7}
    gone = _shards(spark, hash_tree.Tree(40, weights={7: 0.0}))
    assert 7 not in gone.values() and all(gone[i] == even[i] for i in even if even[i] != 7)
    assert 0.3 < Counter(lighter.values())[7] / Counter(even.values())[7] < 0.7


def test_a_reserve_moves_rows_only_in_or_out_of_its_region(spark):
    a = hash_tree.Tree(40)
    b = hash_tree.Tree(40, reserves={(1, 0, 0): 2.0}, weights={1: 2.0})
    assert a.slot_of(1) == (1, 0, 0)
    before, after = _shards(spark, a), _shards(spark, b)
    grew = {i for i in range(40) if a.slot_of(i)[0] == 1}
    moved = [i for i in before if before[i] != after[i]]
    # a refused descent may end differently only where a region, rack or slot on its way changed its reserve
    into = sum(after[i] in grew for i in moved)
    assert moved and into > 0.8 * len(moved)
    assert Counter(after.values())[1] > 1.4 * Counter(before.values())[1]


def test_a_tree_that_is_too_small_or_weightless_is_refused():
    for bad in (dict(shards=65), dict(shards=0), dict(shards=2, weights={0: 2.0}), dict(shards=1, weights={0: 0.0})):
        with pytest.raises(ValueError):
            hash_tree.Tree(**bad)


def test_shard_files_hold_every_row_once_in_gapless_slots(spark):
    rng = random.Random(5)
    rows = [(None if i % 9 == 0 else 5 if i % 3 == 0 else i, None if i % 7 == 0 else "x" * rng.randint(0, 50) + "é", "s", i, None, "r")
            for i in range(900)]
    docs = spark.createDataFrame(rows + rows[:20], SCHEMA).repartition(5)
    path = scratch_path(spark, "t-shards")
    hash_tree.write_shards(spark, docs, path, hash_tree.Tree(6, (2, 2, 2)), file_bytes=2000)
    got = hash_tree.read_shards(spark, path, docs.schema).collect()
    key = lambda r: (repr(r[0]), repr(r[1]), r[3])
    assert sorted(key(r.row) for r in got) == sorted(key(r) for r in rows + rows[:20])  # columns named like ours are kept
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.row.doc_id))
    for s in slots.values():
        assert sorted(x for x, _ in s) == list(range(len(s)))
        known = [d for _, d in sorted(s, key=lambda p: p[0]) if d is not None]
        assert known == sorted(known)
    assert len({r.shard for r in got if r.row.doc_id is None}) == 1 and len({r.shard for r in got if r.row.doc_id == 5}) == 1


def test_no_rows_give_no_shards(spark):
    docs, path = spark.createDataFrame([], SCHEMA), scratch_path(spark, "t-shards")
    hash_tree.write_shards(spark, docs, path, hash_tree.Tree(3))
    assert hash_tree.read_shards(spark, path, docs.schema).isEmpty()


# ---------------------------------------------------------- spelling variants
def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else (a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:])


def _variants(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 2}
    near = {w: [x for x in n if _near(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        if xs:
            best = min(xs, key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def _texts(seed=3, docs=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 10))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "ÀÉ×÷abcd", "Straße" * 40]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.12)), len(base) - 1)]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "b" + w[at:], w[:at] + "á" + w[at + 1:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1", "\n"]).join(words)))
    return rows + [(None, rows[0][1]), (None, rows[1][1]), rows[2], rows[2], (7, None), (8, "")]


@pytest.mark.parametrize("block_rows", [40_000, 150])
def test_variants_match_brute_force(spark, block_rows):
    rows = _texts()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    got = {tuple(r) for r in fm_variants.variant_groups(spark, docs, block_rows=block_rows).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()}
    want = _variants(rows)
    assert got == want and any(f for _, f, *_ in want)


def test_crowded_halves_are_salted_and_lose_nothing(spark):
    rng = random.Random(11)
    words = sorted({"abc" + "".join(rng.choice("xyz") for _ in range(rng.randint(4, 5))) for _ in range(900)})
    n = {w: rng.randint(2, 400) for w in words}
    got = fm_variants.near_words(spark, spark.createDataFrame(list(n.items()), "word string, n long"), block_rows=40)
    got = {r.word: (r.near, r.best_n, r.best) for r in got.collect()}
    want = {}
    for w in words:
        xs = [x for x in words if _near(w, x)]
        if xs:
            best = min(xs, key=lambda x: (-n[x], x))
            want[w] = (len(xs), n[best], best)
    assert got == want


def test_long_texts_are_read_run_by_run(spark, monkeypatch):
    rows = _texts(docs=5)
    monkeypatch.setattr(fm_variants, "_LONG", 10)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["" if d is None else str(d) for d, _ in rows]), pa.array([t for _, t in rows])], ["id", "text"])
    a = Counter(dict(zip(*[c.to_pylist() for c in next(fm_variants.count_words(iter([batch]), 7)).columns])))
    monkeypatch.undo()
    b = Counter(dict(zip(*[c.to_pylist() for c in next(fm_variants.count_words(iter([batch]), 7)).columns])))
    assert a == b and a


def test_no_texts_give_no_words(spark):
    for rows in ([], [(1, None), (2, "")]):
        assert fm_variants.variant_groups(spark, spark.createDataFrame(rows, "doc_id long, text string")).isEmpty()


def test_chains_end_at_their_last_word(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w3")]
    got = {r.word: r.root for r in fm_variants.roots(spark, spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w11" for w, _ in chain}


# -------------------------------------------------------------- ranked search
def _terms(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _ranked(docs, items, k=50):
    got = [(d, Counter(_terms(t))) for d, t in docs]
    got = [(d, c, sum(c.values())) for d, c in got if c]
    n_docs, total = len(got), sum(n for *_, n in got)
    df = Counter(t for _, c, _ in got for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for d, c, n in got:
            m = 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, d is None, d if d is not None else 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def _corpus(seed=4, n=700):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Ünï", "x9"]
    draw = lambda m: " ".join(vocab[min(int(rng.expovariate(0.02)), 301)] for _ in range(m))
    docs = [(i, draw(rng.randint(1, 80))) for i in range(n)]
    docs += [(n + i, "w1 W2, w2; w3") for i in range(150)]  # copies tie
    docs += [(None, "w1 w2 w250"), (None, None), (1, docs[1][1]), (1, docs[1][1]), (n + 900, ""), (n + 901, "--"), (n + 902, "w5 " * 30_000)]
    items = [(i, draw(rng.randint(1, 30))) for i in range(25)] + [(100, ""), (101, None), (102, "absent"), (3, "w290 w1"), (None, "w7 w8")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"max_terms": 40}, {"shares": (), "k": 5}, {"shares": (0.001, 0.01, 0.1, 0.5), "k": 3}])
def test_search_matches_brute_force(spark, options):
    docs, items = _corpus()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int").repartition(7)
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    got = sorted((tuple(r) for r in norm_buckets.ranked_search(spark, d, q, **options).collect()), key=repr)
    assert got == _ranked(docs, items, options.get("k", 50))


def test_small_slices_prune_without_loss(spark, monkeypatch):
    """Bounds of many small slices, in this process."""
    import numpy as np

    monkeypatch.setattr(norm_buckets, "SLICE", 8)
    rng = np.random.default_rng(2)
    n_terms, rows = 40, 400
    dense = rng.integers(1, 10**9, (rows, n_terms)) * (rng.random((rows, n_terms)) < 0.2)
    items = [np.sort(rng.choice(n_terms, rng.integers(1, 12), replace=False)) for _ in range(20)]
    norm = np.sqrt((dense.astype(float) ** 2).sum(1))
    order = np.argsort(-norm)
    dense, norm = dense[order], norm[order]
    best = norm_buckets._Best(np.zeros(20, np.int64), 6)
    for i in range(0, rows, 8):
        part = dense[i:i + 8]
        r, t = np.nonzero(part)
        norm_buckets.scan_slice(norm[i:i + 8], np.searchsorted(r, np.arange(9)), t, part[r, t], list(range(i, i + 8)), items,
                                np.arange(n_terms), best, n_terms)
    for j, item in enumerate(items):
        want = sorted(((-int(s), i) for i, s in enumerate(dense[:, item].sum(1)) if s > 0))[:6]
        assert [(-s, i) for s, i in zip(best.score[j].tolist(), best.id[j])] == want


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert norm_buckets.ranked_search(spark, docs, items).isEmpty()
    assert norm_buckets.ranked_search(spark, spark.createDataFrame([(1, "a")], docs.schema), items.limit(0)).isEmpty()


# ------------------------------------------------- earlier operators, mended
def test_quality_gradient_is_that_of_all_rows(spark):
    import numpy as np

    from revlens.llm import pu_quality as PU

    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["good", "Text", "!!", "12", "a.b"], rng.integers(0, 60))) for _ in range(300)]
    rows = [(i % 250 if i % 11 else None, t) for i, t in enumerate(texts)]
    featured = PU._featured(spark.createDataFrame(rows, "id long, text string").repartition(5))
    edges = PU.bin_edges(featured, 8)
    marked = featured.select("x", (F.coalesce(F.col("id"), F.lit(0)) % 3 == 1).alias("trusted"))
    blocks = PU._binned(marked, edges)
    size = PU.FEATURES * (max(len(e) for e in edges) + 1)
    w = rng.normal(0, 0.3, size + 1)
    got = PU.risk_gradient(PU._summed(blocks, w), 300, w, 0.6, 0.0)

    local = marked.collect()
    bins = PU._bins(np.array([r.x for r in local], np.float32), edges)
    pos = np.array([r.trusted for r in local])
    one = np.zeros((300, size + 1))
    one[np.arange(300)[:, None], bins] = 1
    one[:, -1] = 1

    def risk(w, sign, own):
        return np.logaddexp(0, -sign * (one[own] @ w)).mean()

    def total(w):
        back = risk(w, -1, np.ones(300, bool)) - 0.6 * risk(w, -1, pos)
        return 0.6 * risk(w, 1, pos) + back if back >= 0 else -back

    for at in (0, 5, int(bins[0, 3]), size):
        step = np.zeros(size + 1)
        step[at] = 1e-6
        assert abs((total(w + step) - total(w - step)) / 2e-6 - got[at]) < 1e-6


def test_line_plan_keeps_the_sort_and_the_first_occurrence(spark):
    from revlens.llm import line_dedup

    docs = spark.createDataFrame([(i, f"same\nown {i}\nsame") for i in range(12)], "doc_id long, text string")
    plans = []
    real = line_dedup.materialize
    try:
        line_dedup.materialize = lambda s, df, tag: (plans.append((tag, df._jdf.queryExecution().executedPlan().toString())), real(s, df, tag))[1]
        got = line_dedup.drop_repeated_lines(spark, docs).collect()
    finally:
        line_dedup.materialize = real
    plan = dict(plans)["repeated"]
    assert "Window" in plan and "row_number" in plan and "Sort [hash" in plan and plan.count("rangepartitioning(hash") == 1
    assert all(r.kept_text == f"own {r.doc_id}" and r.n_dropped == 2 for r in got)


def test_urls_that_repeat_or_are_of_one_kind(spark):
    from revlens.llm import url_gbt

    two = spark.range(6000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, "http://a.org/x").otherwise("http://b.com/de/y").alias("url"))
    more = spark.createDataFrame([(-1, "http://c.net/" + "z" * 20_000), (-2, None)], "page_id long, url string")
    got = url_gbt.judge_urls(spark, two.unionByName(more), trees=2, max_train_rows=1)
    verdict = {(r.host, r.verdict) for r in got.select("host", "verdict").distinct().collect()}
    assert {("a.org", "allow"), ("b.com", "block")} <= verdict and got.count() == 6002
    one = url_gbt.judge_urls(spark, two.where("page_id % 2 = 0").unionByName(more), trees=2).collect()
    assert {r.verdict for r in one} == {"allow"}
