"""Training-data operators against brute force, exact round trips and edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import exact_dedup, interpolation, line_dedup, lsh_forest, packing, pu_quality, token_blocks, toxicity, url_gbt, winnow
from revlens.llm.common import connected_components, id_crc
from revlens.llm.encode import Encoder
from revlens.session import scratch_path

SCHEMA = "doc_id long, text string, id string, key string, hits int"  # extra columns with names the operators use inside
WORDS = "the a of and red green blue sun moon tree river stone bird cloud".split()


def text_of(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n)) if n else ""


def edge_rows():
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    base = text_of(1, 120)
    rows = [(1, None), (2, ""), (3, "  \t "), (4, "One"), (5, base), (6, base), (6, base), (7, base + " extra"), (8, long),
            (None, base), (9, "Éa B\nc  d"), (10, "line\nline\n\nline"), (11, long + " end"), (12, text_of(2, 4)), (13, "x\x1fy <|endoftext|> z")]
    return [(i, t, "x", "y", 0) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_winnowing_equals_brute_force_both_ways(spark, docs, empty):
    rng = np.random.default_rng(5)
    items = [(i, text_of(100 + i, n)) for i, n in enumerate((20, 13, 40, 5, 1, 0, 12))] + [(7, None), (0, "again one two")]
    rows = [r[:2] for r in edge_rows()]
    for i in range(30):
        own = text_of(200 + i, 60).split()
        if i % 2:
            w = items[rng.integers(0, 3)][1].split()
            own[10:10] = w[:int(rng.integers(10, 18))]
        rows.append((1000 + i, " ".join(own).upper()))
    frame = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    want = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, x in items:
            x = words(x)
            n = min(13, len(x))
            for s in range(len(x) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == x[s:s + n]:
                        hit |= set(range(p, p + n))
                        found.add(str(item))
        want.append((i, len(w), len(hit), sorted(found)))
    for bound in (2_000_000, 0):
        got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in winnow.decontaminate(spark, frame, bench, max_broadcast=bound).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert winnow.decontaminate(spark, empty, bench).count() == 0
    assert winnow.decontaminate(spark, docs, bench.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_duplicates(spark, docs, empty, bits):
    rows = [r[:2] for r in edge_rows()]
    want = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_duplicates(spark, docs, key_bits=bits, bucket_keys=2).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_duplicates(spark, empty).count() == 0


def test_exact_duplicates_owners_over_batches_and_hot_parts(spark):
    """Chains and answers over batch ends, a hot key in several parts, repeated ids; a row without index entry is an error."""
    rows = [(i if i % 9 else None, "hot" if i % 3 else f"t{i % 50}") for i in range(3000)] + [(77, "hot")] * 5
    want = []
    for t in {t for _, t in rows}:
        ids = [i for i, u in rows if u == t]
        keep = max(i for i in ids if i is not None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for bits in (64, 3):
            got = [tuple(r) for r in exact_dedup.exact_duplicates(spark, frame, key_bits=bits, bucket_keys=4).collect()]
            assert sorted(got, key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    lone = spark.createDataFrame([(5, 1, None, None, None, 3), (6, 2, "x", None, 9, None)],
                                 "key long, n long, text_sha256 string, x string, id long, top long")
    with pytest.raises(Exception, match="not in the index"):
        exact_dedup._answers(lone.coalesce(1).sortWithinPartitions("key"), "bigint").collect()


def test_directory_splits_and_doubles():
    depth, slots = exact_dedup.build_directory({0: 5, 1: 1, 6: 1}, 3, 2)
    assert depth == 3 and slots == [0, 1, 2, 2, 4, 4, 4, 4]
    assert exact_dedup.build_directory({}, 0, 2) == (0, [0])


def test_line_bitmaps(spark, docs, empty):
    rows = [(i, f"Common {'É' if i % 2 else 'é'}\n  COMMON x\t\n\nown {i}\ncommon X") for i in range(12)] + [r[:2] for r in edge_rows()]
    frame = spark.createDataFrame([(100 + i if i is not None else None, t, "x", "y", 0) for i, t in rows], SCHEMA)
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    seen = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            seen.setdefault(key(x), set()).add(i)
    for least in (10, 5):
        want = []
        for i, t in rows:
            own = (t or "").split("\n")
            left = [x for x in own if not (key(x) and len(seen[key(x)]) >= least)]
            want.append((100 + i if i is not None else None, len(own), len(own) - len(left), "\n".join(left)))
        got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.drop_repeated_lines(spark, frame, min_docs=least).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert line_dedup.drop_repeated_lines(spark, empty).count() == 0
    plan = line_dedup.drop_repeated_lines(spark, frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    rng = np.random.default_rng(9)
    rows = [r[:2] for r in edge_rows()]
    for g in range(12):
        base = text_of(300 + g, int(rng.integers(30, 150))).split()
        for c in range(8):
            own = list(base)
            for p in rng.integers(0, len(own), int(rng.integers(0, 6))):
                own[p] = f"new{g}{c}{p}"
            rows.append((2000 + 10 * g + c, " ".join(own)))
    frame = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA)

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    want = [(d, len(sets[i]), low.get(find(i)), d == low.get(find(i))) for i, (d, _) in enumerate(rows)]
    for block in (128, 3):
        got = [tuple(r) for r in lsh_forest.near_duplicates(spark, frame, block_docs=block).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert lsh_forest.near_duplicates(spark, empty).count() == 0


def joined(nodes, links):
    """Smallest node of each node's component."""
    low = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return low


def test_links_inside_a_large_region_are_whole(spark):
    """A crowd of near copies, strangers that share a passage, and sets that share their rare shingles: each region in blocks of four."""
    rng = np.random.default_rng(21)
    sets = {}
    for i in range(60):  # region 1: near copies of one set
        sets[1, i] = set(range(1000, 1080)) - {1000 + int(x) for x in rng.integers(0, 80, 6)}
    for i in range(60, 100):  # region 1 too: half a passage, and some pairs among them
        own = 5000 + 100 * (i // 2)
        sets[1, i] = set(range(1000, 1040)) | set(range(own, own + 40)) - {own + int(x) for x in rng.integers(0, 40, int(rng.integers(2, 16)))}
    for i in range(200, 230):  # region 2: drawn from the same hundred shingles, some of them alike
        sets[2, i] = {int(x) for x in np.random.default_rng(i // 3).permutation(100)[:60 - i % 7]}
    rows = [(r, i % 5, 25 if r == 1 else 8, i, 7 * i, np.sort(np.array(sorted(s), np.uint64)).tobytes()) for (r, i), s in sets.items()]
    rows += rows[::9]  # rows read again by another task
    frame = spark.createDataFrame(rows, "region long, block int, blocks int, id long, row long, set binary").repartition(5)
    near = [(a, b) for (r, a), x in sets.items() for (q, b), y in sets.items()
            if r == q and a < b and 100 * len(x & y) >= 75 * len(x | y)]
    want = joined([i for _, i in sets], near)
    assert 10 < len(set(want.values())) < len(sets) - 50
    got = lsh_forest._region_links(spark, frame, "bigint", 75, 4, 1 << 18).collect()
    assert joined([i for _, i in sets], [tuple(r) for r in got]) == want
    assert all(want[a] == want[b] for a, b in got)


def test_prefixes_of_similar_sets_meet(spark):
    rng = np.random.default_rng(3)
    sets = []
    for i in range(40):
        base = rng.integers(0, 2**63, int(rng.integers(1, 40)))
        sets += [np.unique(base).astype(np.uint64), np.unique(np.r_[base[:-1], rng.integers(0, 2**63, i % 3)]).astype(np.uint64)]
    sets = [s for s in sets if len(s)]
    frame = spark.createDataFrame([(1, i, i, i, s.tobytes()) for i, s in enumerate(sets)], "region long, grp long, id long, row long, set binary")
    got = {}
    for r in lsh_forest._prefixes(frame, "bigint", 75).collect():
        got.setdefault(r.id, set()).add(r.part)
    for a, x in enumerate(sets):
        assert len(got[a]) == len(x) - math.ceil(0.75 * len(x)) + 1
        for b, y in enumerate(sets):
            if 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y)):
                assert got[a] & got[b]


def test_near_duplicates_of_a_repeated_id(spark):
    """One id holds a third of all rows, with repeats and texts of its own: its sets are dealt over blocks, its rows are one document."""
    base = text_of(70, 90).split()
    rows = [(1, " ".join(base[:i] + [f"own{i}"] + base[i:])) for i in range(1, 60)] + [(1, " ".join(base))] * 80
    rows += [(1, text_of(900, 60))] * 3 + [(5, text_of(900, 60) + " more"), (9, text_of(901, 60)), (8, text_of(901, 60) + " more")]
    rows += [(100 + i, " ".join(base[:i] + [f"other{i}"] + base[i:])) for i in range(60)]
    frame = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA).repartition(4)
    for block in (4, 128):
        got = lsh_forest.near_duplicates(spark, frame, block_docs=block).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (5, 1), (8, 8), (9, 8)} | {(100 + i, 1) for i in range(60)}
        assert all(r.kept == (r.doc_id in (1, 8)) for r in got)


def test_near_duplicates_in_a_crowd_that_shares_a_passage(spark):
    """Every document holds the same passage (half of its words); pairs just above the threshold are all found, nothing else is linked."""
    rng = np.random.default_rng(31)
    passage = " ".join(f"p{i}" for i in range(60))
    rows, want, above = [], {}, []
    for i in range(1500):
        own = [f"o{i}x{j}" for j in range(60)]
        rows.append((2 * i, passage + " " + " ".join(own)))
        want[2 * i] = 2 * i
        if i % 5 == 0:
            cut = int(rng.integers(10, 32))
            rows.append((2 * i + 1, passage + " " + " ".join(own[:-cut] + [f"n{i}x{j}" for j in range(cut)])))
            same, size = 116 - cut, 116
            linked = 100 * same >= 75 * (2 * size - same)
            above += [same / (2 * size - same)] * linked
            want[2 * i + 1] = 2 * i if linked else 2 * i + 1
    assert len(above) > 50 and min(above) < 0.77
    frame = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA).repartition(8)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark, frame, block_docs=32).collect()}
    assert got == want


def test_chains_are_named_by_their_smallest_id():
    ids = pa.array([7, 3, 9, 2, 5, 5])
    assert lsh_forest._chain_heads(ids, np.array([1, 2, 4])).tolist() == [1, 1, 1, 3, 3, 5]
    assert lsh_forest._chain_heads(pa.array(["b", "a"]), np.array([1])).tolist() == [1, 1]
    assert lsh_forest._chain_heads(ids[:0], np.zeros(0, int)).tolist() == []


def test_candidates_join_what_adjacent_rows_join(spark):
    """Groups that run over several batches and partitions stay in one piece."""
    signature = np.arange(lsh_forest.SIGNATURE, dtype=np.uint32)
    rows = [(int(i), bytearray((signature + np.uint32(1000 * (i % 3))).tobytes())) for i in np.random.default_rng(4).permutation(400)]
    classes = spark.createDataFrame(rows, "id long, sig binary")
    batch, parts = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions"
    before = spark.conf.get(batch), spark.conf.get(parts)
    try:
        spark.conf.set(batch, 16)
        spark.conf.set(parts, 7)
        pairs = lsh_forest.candidate_pairs(spark, classes, "bigint", 60)
        got = {(r.node, r.root) for r in lsh_forest.connected_components(spark, pairs).collect()}
    finally:
        spark.conf.set(batch, before[0])
        spark.conf.set(parts, before[1])
    assert got == {(i, i % 3) for i in range(400)}


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_encoder_equals_the_library(spark):
    rng = np.random.default_rng(2)
    marks = list(" \n\t'.!<|>1a\u0301") + ["aZ", "é", "×", "\u00a0", "\u3000", "ß", "漢", "  ", "'s", "<|endoftext|>", "\x1c"]
    texts = ["".join(rng.choice(marks, rng.integers(0, 25))) for _ in range(3000)] + [r[1] or "" for r in edge_rows()]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        want = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        got = [ids[at[r]:at[r + 1]].tolist() for i, j, ids, at in Encoder(path).batches(pa.array(texts), 5000) for r in range(j - i)]
        assert got == want


def expected_ids(rows, name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    return [(i, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for i, t in rows]


def test_packing_holds_each_id_once_without_padding(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [tuple(r) for r in packing.pack_documents(docs, path, pool_tokens=5000).collect()]
    ids = {}
    for i, x in expected_ids([r[:2] for r in edge_rows()], "word_bpe_49k.json"):
        ids.setdefault((i, len(x)), []).append(x)
    held, sequences = {}, {}
    for d, start, length, crc, total, seq, offset, tier, _ in rows:
        x = ids[d, total][0]
        assert zlib.crc32(x[start:start + length].tobytes()) == crc and length > 0
        held[d, total] = held.get((d, total), 0) + length
        sequences.setdefault(seq, []).append((offset, length, tier))
    assert held == {k: k[1] * len(v) for k, v in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length, tier in sorted(pieces):
            assert offset == at
            at += length
        assert at == tier <= 4096 and at & (at - 1) == 0
    assert packing.pack_documents(empty, path).count() == 0


def test_token_files_round_trip(spark, docs, empty):
    name = "byte_bpe_50k.json"
    path = scratch_path(spark, "test-tokens")
    token_blocks.write_token_files(docs, path, public_tokenizers.path(name), frame_ids=4000)
    got = sorted((tuple(r) for r in token_blocks.read_token_files(spark, path).collect()), key=lambda r: r[1])
    rows = sorted((r[:2] for r in edge_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = [], 0
    for i, x in expected_ids(rows, name):
        want.append((i, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert got == want
    none = scratch_path(spark, "test-tokens")
    token_blocks.write_token_files(empty, none, public_tokenizers.path(name))
    assert token_blocks.read_token_files(spark, none).count() == 0


def test_token_files_split_equal_ids(spark):
    texts = [text_of(3000 + i, 30) for i in range(200)] + [text_of(1, 30)] * 200
    frame = spark.createDataFrame([(None, t) for t in texts] + [(i, text_of(i, 30)) for i in range(100)], "doc_id long, text string").repartition(4)
    path, conf = scratch_path(spark, "test-tokens"), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        token_blocks.write_token_files(frame, path, public_tokenizers.path("byte_bpe_50k.json"), frame_ids=500, frames_per_file=2)
    finally:
        spark.conf.set(conf, before)
    files = [list(token_blocks.frames(r.content)) for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    nulls = {}
    for f in (f for own in files for f in own):
        nulls[f.part] = nulls.get(f.part, 0) + int(f.null_ids.sum())
    assert max(map(len, files)) <= 2 and sum(nulls.values()) == 400 and max(nulls.values()) < 130
    got = sorted(token_blocks.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 400 + list(range(100))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    rows = frame.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(x.tobytes())) for _, x in expected_ids(rows, "byte_bpe_50k.json")]


def test_blocks_keep_outliers_and_ranges():
    rng = np.random.default_rng(4)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(7, 300, n)).astype(np.uint32)
        f = token_blocks.Frame(token_blocks.encode_frame(ids, np.zeros(1, np.int64), np.zeros(1), np.array([n]), 0, 0))
        assert (f.read_ids() == ids).all()
        for lo, hi in ((0, 1), (n // 3, n // 2), (n - 1, n)):
            if 0 <= lo < hi <= n:
                assert (f.read_ids(lo, hi) == ids[lo:hi]).all()


def test_lm_base_score_and_counts(spark, docs, empty):
    rows = [r[:2] for r in edge_rows()] + [(3000 + i, text_of(400 + i, 50)) for i in range(60)]
    frame = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA)
    crc = lambda i: zlib.crc32(b"" if i is None else str(i).encode())
    toks = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None]) for i, t in rows]
    count = {}
    for i, w in toks:
        if crc(i) % 7 != 2:
            for x in w:
                count[x] = count.get(x, 0) + 1
    n, v = sum(count.values()), len(count)
    want = [(i, crc(i) % 7 == 2, len(w), sum(x in count for x in w), n, round(sum(np.log10((count.get(x, 0) + 1) / (n + v + 1)) for x in w), 6)) for i, w in toks]
    got = interpolation.score_documents(spark, frame, id_crc() % 7 != 2, F.floor(id_crc() / 7) % 4 == 0, chunk_bytes=4000, range_bytes=9000).collect()
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in got)
    assert interpolation.score_documents(spark, empty, id_crc() % 7 != 2, F.lit(True)).count() == 0


def test_lm_interpolated_score_equals_token_by_token_model(spark):
    """The mixture written out token by token: EM over the deleted part with the counts of the rest, then all training counts."""
    rows = [(i, text_of(600 + i, 30 + i % 40) + (f" rare{i} end" if i % 3 else " end rare")) for i in range(120)] + [(500, None), (501, "unseen only")]
    crc = {i: zlib.crc32(str(i).encode()) for i, _ in rows}
    toks = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for i, t in rows}
    train = [i for i, _ in rows if crc[i] % 7 != 2]
    deleted = [i for i in train if crc[i] // 7 % 4 == 0]
    assert 5 < len(deleted) < len(train) < len(rows)

    def counts(ids):
        one, two = Counter(), Counter()
        for i in ids:
            one.update(toks[i])
            two.update(zip([None, *toks[i][:-1]], toks[i]))
        return one, two

    one, two = counts(train)
    rest = counts(i for i in train if i not in deleted)
    n, types = sum(one.values()), len(one)

    def estimates(ids, one, two, n):
        for i in ids:
            for v, w in zip([None, *toks[i][:-1]], toks[i]):
                yield min(one[v].bit_length(), interpolation.BUCKETS - 1), (two[v, w] / one[v] if one[v] else 0.0, one[w] / n, 1 / (types + 1))

    held = list(estimates(deleted, *rest, sum(rest[0].values())))
    mix = {b: (0.0, 0.5, 0.5) if b == 0 else (1 / 3,) * 3 for b in range(interpolation.BUCKETS)}
    for _ in range(12):
        total = {}
        for b, p in held:
            part = [x * y for x, y in zip(mix[b], p)]
            total[b] = [x + y / sum(part) for x, y in zip(total.get(b, (0, 0, 0)), part)]
        mix.update({b: [x / sum(t) for x in t] for b, t in total.items()})
    want = {i: sum(math.log10(sum(x * y for x, y in zip(mix[b], p))) for b, p in estimates([i], one, two, n)) for i in toks}

    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (700, 1 << 20):  # many chunks and ranges, or one
        got = interpolation.score_documents(spark, frame, id_crc() % 7 != 2, F.floor(id_crc() / 7) % 4 == 0, chunk_bytes=size, range_bytes=size)
        got = {r.doc_id: r.score for r in got.collect()}
        assert got == pytest.approx(want, rel=1e-5)


def test_toxicity_sample_of_repeated_ids_is_bounded_by_rows(spark):
    """An id on most rows, with equal and with different texts: the rows learned from stay within the bound, and the fit still learns."""
    rows = [(i, text_of(i, 30) + (" idiot fool" if i % 4 == 0 else "")) for i in range(100)]
    rows += [(4, "same idiot fool text")] * 3000 + [(3, text_of(5000 + i, 12)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "id long, text string").repartition(4)
    sample = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)], "id long, y int")
    got, _, n = toxicity._labelled(spark, frame, sample, 400)
    kept = [tuple(r) for r in got.select("id", "text").collect()]
    assert n == 400 and 300 < len(kept) < 500 and len(set(kept)) == len(kept)
    got, _, n = toxicity._labelled(spark, frame, sample, 10_000)
    assert n == got.count() == len(set(rows))
    labels = sample.select(F.col("id").alias("doc_id"), F.col("y").alias("toxic"))
    docs = frame.withColumnRenamed("id", "doc_id")
    scored = toxicity.score_toxicity(spark, docs, labels, F.lit(True), max_train_rows=400).collect()
    assert len(scored) == len(rows)
    assert all((r.score >= 0.5) == (r.doc_id == 4) for r in scored if r.doc_id in (3, 4))


def test_classifiers_learn_and_take_edge_rows(spark, docs, empty):
    good = [(i, text_of(500 + i, 40), None, None, 0) for i in range(200)]
    bad = [(1000 + i, f"{text_of(700 + i, 20)} idiot {text_of(900 + i, 20)}!!!! $$$$ ||||", None, None, 0) for i in range(60)]
    frame = spark.createDataFrame(good + bad, SCHEMA).unionByName(docs)
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), int(r[0] >= 1000)) for r in good + bad] + [(None, 1, 1), (5, None, None), (6, 1, 0), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    tox = toxicity.score_toxicity(spark, frame, labels, id_crc() % 5 != 0).collect()
    assert len(tox) == frame.count() and all(0 <= r.score <= 1 for r in tox)
    held = [r for r in tox if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and (r.doc_id >= 1000 or r.doc_id < 200)]
    assert np.mean([(r.score >= 0.5) == (r.doc_id >= 1000) for r in held]) > 0.9
    qual = pu_quality.score_quality(spark, frame, labels, id_crc() % 5 != 0).collect()
    assert len(qual) == frame.count() and all(0 <= r.score <= 1 for r in qual)
    mean = lambda own: np.mean([r.score for r in own])
    assert mean([r for r in qual if r.doc_id is not None and 13 < r.doc_id < 200]) > mean([r for r in qual if (r.doc_id or 0) >= 1000]) + 0.3
    for score in (toxicity.score_toxicity, pu_quality.score_quality):
        assert score(spark, empty, labels, F.lit(True)).count() == 0
        assert score(spark, docs, labels.limit(0), F.lit(True)).count() == docs.count()


def test_toxic_terms_that_few_rows_of_each_shard_have_get_weights(spark):
    rng = np.random.default_rng(11)
    plain = [" ".join(rng.choice(WORDS, 8)) for _ in range(9600)]
    # 100 toxic words: four rows learned from (of over 5,000 in each of two shards), one held out
    toxic = [f"{' '.join(rng.choice(WORDS, 4))} slur{i // 5} {' '.join(rng.choice(WORDS, 4))}" for i in range(500)]
    frame = spark.createDataFrame(list(enumerate(plain + toxic)), "doc_id long, text string").repartition(4)
    labels = frame.select("doc_id", (F.col("doc_id") >= len(plain)).cast("int").alias("toxic"))
    held = F.when(F.col("doc_id") >= len(plain), (F.col("doc_id") - len(plain)) % 5 == 0).otherwise(F.col("doc_id") % 12 == 0)
    labels = labels.unionByName(spark.range(20_000, 20_900).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic")))
    score = toxicity.score_toxicity(spark, frame, labels, ~held).where(held).toPandas()
    bad = score["doc_id"] >= len(plain)
    above = np.mean([(score["score"][~bad] < x).mean() for x in score["score"][bad]])  # area under the curve
    assert bad.sum() == 100 and above > 0.9


def test_url_rules_and_trees(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/1", "https://example.org/en/12?x=1", "ftp://x.org", "http://org/a", "http://b.com/de/1#f",
            "http://b.com/fr/1", "http://b.com/en/1", "http://notexample.org/es/", "://c.net/q?u://v"]
    rows = [(i, u, "z") for i, u in enumerate(urls)] + [(100 + i, f"http://{'spam' if i % 2 else 'news'}{i}.com/{'de' if i % 2 else 'fr'}/{i}", "z") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {r.page_id: r for r in url_gbt.judge_urls(spark, pages, trees=3).collect()}
    assert len(got) == len(rows)
    want = {0: ("", "", None), 1: ("", "", None), 2: ("", "", None), 3: ("a.example.org", "/es/1", "example.org/es/"),
            4: ("example.org", "/en/12", "example.org/en/1"), 5: ("x.org", "", None), 6: ("org", "/a", "org/"), 7: ("b.com", "/de/1", "com/de/"),
            8: ("b.com", "/fr/1", "com/fr/"), 9: ("b.com", "/en/1", None), 10: ("notexample.org", "/es/", "org/"), 11: ("c.net", "/q", None)}
    for i, w in want.items():
        assert (got[i].host, got[i].path, got[i].rule) == w
    assert {r.verdict for r in got.values()} == {"allow", "block"} and got[3].verdict == "block" and got[10].verdict == "allow"
    assert url_gbt.judge_urls(spark, pages.limit(0)).count() == 0
